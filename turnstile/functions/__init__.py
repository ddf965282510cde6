from turnstile.functions.expressions import (
    epoch_day_string,
    hash_rank_key,
    hash_uniform,
    is_missing,
    name_lookup,
    sentinel_null,
)

__all__ = ["epoch_day_string", "hash_rank_key", "hash_uniform", "is_missing",
           "name_lookup", "sentinel_null"]
