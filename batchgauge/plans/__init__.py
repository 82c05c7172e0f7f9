"""Daily, backfill and pre-flight jobs put together from the operators."""
