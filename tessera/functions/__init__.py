"""Column-level helpers (no Python UDFs)."""

from .geo import geohash, geohash_bounds
from .maps import count_map, last_value_per_key, merge_map, merge_maps_last_wins
from .scalar import (clean_sentinel, clip_upper, code_map, date_to_int, day_sequence_desc, edge_label,
                     epoch_ms_to_day, int_to_date, jvm_split, list_contains, map_to_text, name_id, non_blank,
                     phrase_tokens, safe_div, say_hello, word_count)
from .text import index_tokens, normalise_token, whitespace_tokens

__all__ = [
    "geohash", "geohash_bounds", "count_map", "last_value_per_key", "merge_map", "merge_maps_last_wins",
    "clean_sentinel", "clip_upper", "code_map", "date_to_int", "day_sequence_desc", "edge_label",
    "epoch_ms_to_day", "int_to_date", "jvm_split", "list_contains", "map_to_text", "name_id", "non_blank",
    "phrase_tokens", "safe_div", "say_hello", "word_count", "index_tokens", "normalise_token",
    "whitespace_tokens",
]
