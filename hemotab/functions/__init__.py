"""Column functions: recodes, ages, expiry, prevalence and co-infection labels."""

from hemotab.functions.recodes import (
    age_band,
    age_years,
    blood_grouping,
    blood_type,
    coinfection,
    component_status_label,
    counselling_label,
    expiry_status,
    order_status_label,
    prevalence,
    tti_reactive_status,
)

__all__ = [
    "age_band", "age_years", "blood_grouping", "blood_type", "coinfection",
    "component_status_label", "counselling_label", "expiry_status",
    "order_status_label", "prevalence", "tti_reactive_status",
]
