"""Advertising events out of the ``events`` test table.

The table holds generic web events; this projection gives them the two event shapes, with a fixed
share of rows that break each validation rule. It squeezes 30 days into one hour, so that
one-minute windows hold several rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import Side, side_of

AS_OF = "2024-01-01 01:00:00"  # the "now" of the validation rules
BASE_MICROS = 1_704_067_200_000_000  # 2024-01-01 00:00:00 UTC
SQUEEZE = 720


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def adapt(events: DataFrame, side: str | Side, also: tuple[str, ...] = ()) -> DataFrame:
    """Project the table (or a stream of it) to the event schema of a side, and the columns in ``also``."""
    side = side_of(side)
    ssp = side.name == "ssp"

    def unless(otherwise: str, *cases: tuple[int, str]) -> str:
        whens = " ".join(f"WHEN event_id % {m} = 0 THEN {value}" for m, value in cases)
        return f"CASE {whens} ELSE {otherwise} END"

    hour = 3_600_000_000
    micros = f"(unix_micros(cast(ts AS timestamp)) - {BASE_MICROS})"
    squeezed = f"{BASE_MICROS} + {micros} div {SQUEEZE}"
    actions = ", ".join(f"'{a}'" for a in side.actions)
    columns = {
        "event_id": unless("string(event_id)", (101, "''")),
        "timestamp": f"timestamp_micros({unless(squeezed, (103, f'{squeezed} - 25 * {hour}'), (107, f'{squeezed} + 2 * {hour}'))})",
        "ad_id": unless("concat('ad-', user_id % 20)", (149, "''")),
        "campaign_id": unless("concat('camp-', user_id % 5)", (109, "'  '")),
        "creative_id": unless("concat('cr-', user_id % 7)", (151, "''")),
        "advertiser_id": unless("concat('adv-', (event_id div 9) % 3)", (157, "''")),
        "user_id": unless("concat('user-', user_id)", (163, "''")),
        "action": unless(f"element_at(array({actions}), int(event_id % 9 + 1))", (127, "'BID_WIN'" if ssp else "'AD_RENDER'")),
        "metadata": "map('k', get_json_object(props, '$.k'))",
    }
    if ssp:
        columns |= {
            "publisher_id": unless("concat('pub-', (event_id div 27) % 4)", (113, "''")),
            "floor_price": unless("value * 3", (131, "-value")),
            "winning_bid": unless("value", (137, "-value")),
            "ad_slot": "concat('slot-', user_id % 3)",
            "page_url": "concat('/p/', user_id % 11)",
        }
    else:
        columns |= {
            "bid_price": unless("value * 6", (131, "-value")),
            "clearing_price": unless("value", (137, "-value")),
            "budget_remaining": unless("500 - value", (139, "-value")),
            "targeting_segments": "array(event_type)",
        }
    return events.selectExpr(*[f"{columns[f.name]} AS {f.name}" for f in side.event.fields], *also)
