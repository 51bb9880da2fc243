from hourly_star.functions.calendar import date_key, local_time, padded_name
from hourly_star.functions.keys import reading_key
from hourly_star.functions.predicates import differs, exceeds, outside
from hourly_star.functions.numbers import exact_mean
from hourly_star.functions.units import normalised_unit

__all__ = ["date_key", "differs", "exact_mean", "exceeds", "local_time",
           "normalised_unit", "outside", "padded_name", "reading_key"]
