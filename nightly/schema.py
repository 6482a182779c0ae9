"""Fixed schemas of the data model and the schema fingerprint."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import types as T

# One sleep session after normalisation.
SLEEP_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("start_ts", T.TimestampType(), False),
        T.StructField("end_ts", T.TimestampType(), False),
        T.StructField("duration_min", T.DoubleType(), False),
        T.StructField("efficiency", T.DoubleType(), False),
        T.StructField("is_nap", T.BooleanType(), False),
        T.StructField("tz", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
    ]
)

SLEEP_COLUMNS = SLEEP_SCHEMA.fieldNames()

# One forecast value; `lower` and `upper` are NULL for models without a band.
FORECAST_COLUMNS = ["model", "target", "date", "prediction", "lower", "upper", "actual"]


def schema_hash(schema: T.StructType = SLEEP_SCHEMA) -> str:
    """SHA-256 of the schema as JSON with sorted keys."""
    doc = json.dumps(json.loads(schema.json()), sort_keys=True)
    return hashlib.sha256(doc.encode("utf-8")).hexdigest()
