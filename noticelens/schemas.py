"""Schemas of the tables users bring or get, as DDL."""

from __future__ import annotations

from pyspark.sql.types import StructType

SCHEMAS = {
    "participated": "notice_name string, bid_company_name string",
    "ineligible": "notice_name string",
    "balanced": "service_title string, label int",
    "vectors": "id bigint, embedding array<float>, title string, label int",
    "notices": "id bigint, service_title string, participating_dept string",
    "knowledge_base": "final_label string, keywords string, div string, dep string",
    "mapping": "key string, value string",
    "taxonomy": "key string, value array<string>",
    "clustered": "service_title string, service_title_cleaned string, x double, y double, cluster_id int",
    "train_multi": "text string, label string",
    "predictions": "id bigint, label int, logits array<double>",
    "strategy_runs": "strategy string, metric string, value double",
    "request": "id string, text string",
    "result": "original_id string, possibility double, category string",
    "replies": "id bigint, response string",
}


def schema(name: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[name])
