"""hemotab: blood-service reporting on Spark.

Source tables -> seven summary views -> period-filtered datasets ->
nested cross-tabulations with subtotals, all as Spark DataFrame plans.

Typical use::

    from hemotab import Tables, run_report, write_report
    tables = Tables.from_files(spark, root)
    out = run_report(tables, "donation", "2024-01-01", "2024-03-31")
"""

from hemotab.plans.materialize import use_all_bases, write_all_bases
from hemotab.plans.reports import REPORTS, crosstab, dataset, run_report, run_reports
from hemotab.plans.views import VIEWS, register_views
from hemotab.profile import PROFILES, Profile, fixture_profile
from hemotab.sources.sinks import write_report
from hemotab.sources.tables import Tables

__all__ = [
    "PROFILES", "Profile", "REPORTS", "Tables", "VIEWS", "crosstab", "dataset", "fixture_profile",
    "register_views", "run_report", "run_reports", "use_all_bases", "write_all_bases", "write_report",
]
