"""Release profiles: the values that differ between the three releases.

Code never hard-wires status codes or test ids; views take a
:class:`Profile`.  ``PROFILES["1.4.0"]`` is the default.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any

DISEASES = ("hiv", "hbv", "hcv", "syphilis")

# --- fixed values (must equal the reference's) -------------------------------
# Repeat-test ids per disease, (repeat 1, repeat 2), release 1.4.0: 16-byte
# binary keys written as hex.
TEST_IDS_140 = {
    "hiv": ("11e868b09117325d8826e4a471449260", "11e868b091178dbc8826e4a471449260"),
    "hbv": ("11e868b09117960c8826e4a471449260", "11e868b0911799228826e4a471449260"),
    "hcv": ("11e868b091179ed08826e4a471449260", "11e868b09117a19f8826e4a471449260"),
    "syphilis": ("11e868b09117a7418826e4a471449260", "11e868b09117aa0f8826e4a471449260"),
}
# Releases 1.0.0 and 1.3.0: integer keys.
TEST_IDS_INT = {
    "hiv": (18, 19),
    "hbv": (21, 22),
    "hcv": (24, 25),
    "syphilis": (27, 28),
}
# TTI status codes: 1.4.0 uses UNSAFE / SAFE, older releases TTI_UNSAFE / TTI_SAFE.
# --- end of fixed values -----------------------------------------------------


@dataclass(frozen=True)
class Profile:
    """Everything release-specific that a view or report needs.

    ``test_ids`` maps a disease to its two repeat-test ids.  Ids are
    ``bytes`` for binary keys and ``int`` for integer keys.
    """

    name: str
    tti_unsafe: str
    tti_safe: str
    test_ids: dict[str, tuple[Any, Any]] = field(hash=False)
    # Deleted test results are excluded from the joins.
    tests_exclude_deleted: bool = True
    # The issued view drops deleted components.
    issued_requires_live_component: bool = True
    # Donation-date reports take end + 1 day as the closing bound.
    donation_period_plus_one_day: bool = False

    def repeat_ids(self, disease: str) -> tuple[Any, Any]:
        return self.test_ids[disease]

    def all_repeat_ids(self, diseases=DISEASES) -> list[Any]:
        return [i for d in diseases for i in self.test_ids[d]]


def _hex_ids(table: dict[str, tuple[str, str]]) -> dict[str, tuple[bytes, bytes]]:
    return {d: (bytes.fromhex(a), bytes.fromhex(b)) for d, (a, b) in table.items()}


PROFILES: dict[str, Profile] = {
    "1.4.0": Profile(
        name="1.4.0",
        tti_unsafe="UNSAFE",
        tti_safe="SAFE",
        test_ids=_hex_ids(TEST_IDS_140),
    ),
    "1.3.0": Profile(
        name="1.3.0",
        tti_unsafe="TTI_UNSAFE",
        tti_safe="TTI_SAFE",
        test_ids=dict(TEST_IDS_INT),
    ),
    "1.0.0": Profile(
        name="1.0.0",
        tti_unsafe="TTI_UNSAFE",
        tti_safe="TTI_SAFE",
        test_ids=dict(TEST_IDS_INT),
        tests_exclude_deleted=False,
        issued_requires_live_component=False,
        donation_period_plus_one_day=True,
    ),
}

DEFAULT_PROFILE = PROFILES["1.4.0"]

# The derived test tables number their tests 0-7: HIV repeat 1/2 = 0/1,
# HBV = 2/3, HCV = 4/5, syphilis = 6/7.
FIXTURE_TEST_IDS = {"hiv": (0, 1), "hbv": (2, 3), "hcv": (4, 5), "syphilis": (6, 7)}


def fixture_profile(base: Profile | str = "1.4.0") -> Profile:
    """A release profile re-keyed to the integer test ids of the fixtures."""
    if isinstance(base, str):
        base = PROFILES[base]
    return replace(base, name=f"{base.name}+fixture", test_ids=dict(FIXTURE_TEST_IDS))
