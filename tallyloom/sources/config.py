"""Report configuration: small lists the caller keeps in YAML."""

from __future__ import annotations

import yaml
from pyspark.sql import DataFrame, SparkSession

# The time frame and the media sets the reports ask for.
TIMEFRAMES = ({"timeframe": "1 month average", "time_type": 1},)
CATEGORY_SETS = {
    "expanded categories": (778228, 2),
    "topline categories": (20, 2),
    "custom entities": (23, 2),
}
TOP_ENTITIES = "top 5000 entities"
CATEGORIES = {
    "desktop": {**CATEGORY_SETS, TOP_ENTITIES: (26, 2)},
    "local_market": CATEGORY_SETS,
    "multi_platform": {**CATEGORY_SETS, TOP_ENTITIES: (57, 2)},
    "mobile_web_and_app": CATEGORY_SETS,
}
TARGETS = (
    {"target_key": "target", "target_value": 23},
    {"target_key": "target", "target_value": 5},
    {"target_key": "target", "target_value": 106},
    {"target_key": "target", "target_value": 107},
    {"target_key": "targetGroup", "target_value": 15},
)


def category_rows(report: str) -> list[dict]:
    return [
        {"categories": name, "media_set": number, "media_set_type": kind}
        for name, (number, kind) in CATEGORIES[report].items()
    ]


def load_config(path: str) -> dict:
    """Read one report's YAML file into the lists that ``request_grid`` explodes.

    Known keys: timeframe, categories, targets, media_measures and reports. A report entry is one media (id, name) or
    a group of media under ``media``.
    """
    with open(path, encoding="utf-8") as f:
        raw = yaml.safe_load(f) or {}
    config: dict = {"table_name": raw.get("table_name")}
    if "timeframe" in raw:
        config["timeframes"] = [{"timeframe": t["time"], "time_type": t["id"]} for t in raw["timeframe"]]
    if "categories" in raw:
        config["categories"] = [
            {"categories": c["name"], "media_set": c["media_set"], "media_set_type": c["media_set_type"]}
            for c in raw["categories"]
        ]
    if "targets" in raw:
        config["targets"] = [{"target_key": k, "target_value": v} for t in raw["targets"] for k, v in t.items()]
    if "media_measures" in raw:
        config["measures"] = {str(m["id"]): m["name"] for m in raw["media_measures"]}
    reports = raw.get("reports") or []
    if reports and "media" in reports[0]:
        config["media_groups"] = [
            {
                "report_no": i,
                "media_ids": [str(m["id"]) for m in r["media"]],
                "media_names": [m["name"] for m in r["media"]],
            }
            for i, r in enumerate(reports)
        ]
    elif reports:
        config["media"] = [{"media_id": str(m["id"]), "media_name": m["name"]} for m in reports]
    return config


def config_frame(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """One configured list as a (local) frame."""
    return spark.createDataFrame(rows, schema)
