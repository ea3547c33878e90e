from rivulet.functions.keys import canonical_keys, fold, same_key
from rivulet.functions.temporal import decode_date, decode_temporals, decode_timestamp

__all__ = ["canonical_keys", "decode_date", "decode_temporals", "decode_timestamp", "fold", "same_key"]
