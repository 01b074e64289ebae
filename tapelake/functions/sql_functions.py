"""The masking helpers as SQL functions, for users who write SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tapelake.functions.masking import DELETED_PREFIX, REDACTED

_FUNCTIONS = {
    "mask_hash(v STRING)": "md5(v)",
    "mask_partial(v STRING, n INT)": "CASE WHEN v IS NULL THEN NULL WHEN length(v) <= n THEN '***' "
    "ELSE concat(left(v, n), repeat('*', length(v) - n)) END",
    "mask_round(v DOUBLE, n INT)": "CAST(round(CAST(v AS DECIMAL(38, 8)) * power(10, n)) / power(10, n) AS DOUBLE)",
    "mask_redact()": f"'{REDACTED}'",
    "hash_account_id(v STRING)": f"concat('{DELETED_PREFIX}', substr(sha2(v, 256), 1, 16))",
}


def register(spark: SparkSession) -> None:
    """Create the functions for this session; Catalyst inlines them, so they cost what their bodies cost."""
    for signature, body in _FUNCTIONS.items():
        result = "DOUBLE" if signature.startswith("mask_round") else "STRING"
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {result} RETURN {body}")
