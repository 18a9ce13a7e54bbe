from featureflow.functions.columns import bucket_rare, is_missing, lookup, null_if_in
from featureflow.functions.time import cyclic_pair, hhmm_to_minutes, iso_weekday, month_length

__all__ = ["bucket_rare", "is_missing", "lookup", "null_if_in", "cyclic_pair",
           "hhmm_to_minutes", "iso_weekday", "month_length"]
