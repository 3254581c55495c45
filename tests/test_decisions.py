import pytest
from pyspark.sql import functions as F

from noticelens.functions.judgement import parse_judgement
from noticelens.functions.scoring import bid_category, bid_possibility, prob_map, softmax
from noticelens.operators.mapping import dept_match, dept_status, label_info, require_unique
from noticelens.operators.rules import apply_rules
from noticelens.operators.score import score_batch

RULES = [
    ("pipe 3cm supply", "construction_management", "rule:supervision"),
    ("SUPERVISION safety_check", "construction_management", "rule:supervision"),
    ("safety_check", "structural_safety_inspection", "rule:safety_inspection"),
    ("harbor dam safety_inspection", "water_resources_safety_inspection", "rule:safety_inspection"),
    ("dam railway safety_inspection", "railway_track_safety_inspection", "rule:safety_inspection"),
    ("disaster power impact_assessment", "power_impact_assessment", "rule:impact_assessment"),
    ("technical_inspection", "technical_inspection", "rule:technical_inspection"),
    ("soil_pollution survey", "soil_survey", "rule:soil"),
    ("road design", None, ""),
    (None, None, ""),
]


def test_hard_rules(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in RULES], "title string")
    rows = apply_rules(df, "title").collect()
    assert [(r.title, r.rule_label, r.rule_status) for r in rows] == RULES


POSSIBILITY = [
    ({}, 50.0),
    ({"LABEL_0": 0.5, "LABEL_1": 0.5}, 0.6),
    ({"LABEL_0": 0.25, "LABEL_1": 0.75}, 0.8),
    ({"LABEL_0": 0.9, "LABEL_1": 0.1}, 0.12),
    ({"LABEL_1": 1.0}, 1.0),
    ({"LABEL_0": 1.0}, 0.0),
    ({"X": 0.8}, 0.5),
]


def test_bid_possibility(spark):
    df = spark.createDataFrame([(p,) for p, _ in POSSIBILITY], "p map<string,double>")
    got = [r[0] for r in df.select(bid_possibility(F.col("p"))).collect()]
    assert got == [v for _, v in POSSIBILITY]


CATEGORY = [
    ("supervision", {"electrical_comm_fire_supervision": 0.65}, "electrical_comm_fire_supervision"),
    ("supervision", {"electrical_comm_fire_supervision": 0.64}, "construction_management"),
    ("check", {"traffic_safety_inspection": 0.65}, "traffic_safety_inspection"),
    ("technical_inspection", {"road_design": 0.9}, "technical_inspection"),
    ("disaster_protection check", {}, "disaster_impact_assessment"),
    ("impact_assessment", {"traffic_impact_assessment": 0.7}, "traffic_impact_assessment"),
    ("impact_assessment", {}, "environmental_impact_assessment"),
    ("Supervision", {}, "unclassified"),
    ("road", {"road_design": 0.6}, "road_design"),
    ("road", {"road_design": 0.59}, "unclassified"),
]


def test_bid_category(spark):
    df = spark.createDataFrame([(t, p) for t, p, _ in CATEGORY], "t string, p map<string,double>")
    got = [r[0] for r in df.select(bid_category(F.col("t"), F.col("p"))).collect()]
    assert got == [v for _, _, v in CATEGORY]


def test_softmax_and_failed_inference(spark):
    df = spark.createDataFrame([([1000.0, 1000.0],), (None,)], "l array<double>")
    rows = df.select(softmax(F.col("l")).alias("s"), prob_map(F.col("l"), ["a", "b"]).alias("m")).collect()
    assert rows[0].s == [0.5, 0.5] and rows[0].m == {"a": 0.5, "b": 0.5}
    assert rows[1].s is None and rows[1].m == {}


def test_score_batch_keeps_duplicate_ids(spark):
    rows = [("1", "road", [0.0, 5.0], [9.0, 0.0]), ("1", "road", None, None)]
    df = spark.createDataFrame(rows, "id string, text string, binary_logits array<double>, multi_logits array<double>")
    got = [tuple(r) for r in score_batch(df, ["road_design", "soil_survey"]).collect()]
    assert got == [("1", 0.99, "road_design"), ("1", 50.0, "unclassified")]


REPLIES = [
    ('```json\n{"best_label":"x","reason":"y"}\n```', "x", "y"),
    ('{"reason":"y"}', "parse error", "y"),
    ('{"best_label":"x"}', "x", ""),
    ("not json", "classification error", "invalid_reply"),
    ("[1]", "classification error", "invalid_reply"),
    ("null", "classification error", "invalid_reply"),
    ("", "classification error", "invalid_reply"),
    ("{'best_label':'x'}", "classification error", "invalid_reply"),
    ('{"best_label":"x"} extra', "classification error", "invalid_reply"),
    ('{"best_label":null}', None, ""),
    ("{}", "parse error", ""),
    (None, "classification error", "invalid_reply"),
]


def test_parse_judgement(spark):
    df = spark.createDataFrame([(r,) for r, _, _ in REPLIES], "r string")
    got = [tuple(r[0]) for r in df.select(parse_judgement(F.col("r"))).collect()]
    assert got == [(label, reason) for _, label, reason in REPLIES]


DEPTS = [
    ("A, B", "x", "B", "match"),
    ("A,B", "x", "B", "mismatch"),
    ("A", None, "B", "undetermined"),
    ("A", "classification error", "B", "undetermined"),
    ("A", "x", None, "undetermined"),
    ("N/A", "x", "N/A", "match"),
]


def test_dept_status(spark):
    df = spark.createDataFrame([d[:3] for d in DEPTS], "p string, l string, a string")
    got = [r[0] for r in df.select(dept_status(F.col("p"), F.col("l"), F.col("a"))).collect()]
    assert got == [d[3] for d in DEPTS]


def test_lookup_and_audit(spark):
    kb = spark.createDataFrame([("x", "d1", "A, B")], "final_label string, div string, dep string")
    df = spark.createDataFrame([(1, "x", "b"), (2, "y", "A")], "id int, predicted_label string, participating_dept string")
    depts = spark.createDataFrame([("b", "B")], "key string, value string")
    rows = dept_match(label_info(df, kb), depts).orderBy("id").collect()
    assert [(r.predicted_div, r.standard_dept_actual, r.dept_match_status) for r in rows] == [
        ("d1", "B", "match"),
        ("N/A", "A", "mismatch"),
    ]
    missed = label_info(df, kb, default=None).filter("id = 2").first()
    assert missed.predicted_div is None
    skipped = dept_match(label_info(df.drop("participating_dept"), kb), depts)
    assert {r.dept_match_status for r in skipped.collect()} == {"validation_skipped"}
    unmapped = dept_match(label_info(df, kb), None).orderBy("id").collect()
    assert [r.standard_dept_actual for r in unmapped] == ["b", "A"]


def test_duplicate_labels_raise(spark):
    kb = spark.createDataFrame([("x",), ("x",)], "final_label string")
    with pytest.raises(ValueError, match="duplicate"):
        require_unique(kb, "final_label")
