"""Deterministic bad-record injection for the decode/validity checks.

Turns a fraction of encoded events into the bad-record kinds a real stream
carries (not JSON, a text id, a bad time, a missing key), chosen by a rule on
the row key so the expected outcome can be stated independently in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Position in a cycle of 50 rows -> kind of damage.
CYCLE = 50
NOT_JSON, TEXT_CUSTOMER, BAD_TIME, NO_EVENT_ID = 7, 17, 27, 37


def damage(json_col: Column, key_col: Column, event_id: Column) -> Column:
    slot = key_col % CYCLE
    return (F.when(slot == NOT_JSON, F.concat(F.lit("not json "), event_id))
            .when(slot == TEXT_CUSTOMER,
                  F.regexp_replace(json_col, r'"customer_id":-?[0-9]+', '"customer_id":"abc"'))
            .when(slot == BAD_TIME,
                  F.regexp_replace(json_col, r'"event_time":"[^"]*"', '"event_time":"nope"'))
            .when(slot == NO_EVENT_ID, F.regexp_replace(json_col, r'"event_id":"[^"]*",', ""))
            .otherwise(json_col))
