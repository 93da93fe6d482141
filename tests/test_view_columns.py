"""Requesting any single column never changes a view's rows: the joins
left out for unrequested columns are exactly the ones that cannot."""

from __future__ import annotations

import pytest

from hemotab.plans import catalog as C
from hemotab.plans import views as V
from hemotab.profile import fixture_profile

P = fixture_profile()
CASES = [
    (V.donation_summary, V.DONATION_COLUMNS, {"as_of": C.AS_OF}),
    (V.testing_summary, V.TESTING_COLUMNS, {"as_of": C.AS_OF}),
    (V.inventory_summary, V.INVENTORY_COLUMNS, {"as_of": C.EXPIRY_AS_OF}),
    (V.deferral_summary, V.DEFERRAL_COLUMNS, {"as_of": C.AS_OF}),
    (V.discard_summary, V.DISCARD_COLUMNS, {}),
    (V.issued_summary, V.ISSUED_COLUMNS, {}),
]


@pytest.mark.parametrize("fn,columns,kw", CASES, ids=[c[0].__name__ for c in CASES])
def test_single_column_same_rows(small_tables, fn, columns, kw):
    full = fn(small_tables, profile=P, **kw)
    n = full.count()
    assert full.columns == list(columns)
    for col in columns:
        one = fn(small_tables, profile=P, columns=[col], **kw)
        assert one.columns == [col]
        assert one.count() == n, col
