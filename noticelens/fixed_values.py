"""Values that a user's results depend on, stated as plain data."""

from __future__ import annotations

# Hard keyword rules. Each group fires on its trigger for titles no
# earlier group has labelled; within a group a later override beats an earlier one.
# (status, trigger pattern, label, [(override pattern, label), ...])
HARD_RULES = [
    (
        "rule:supervision",
        "supervision|construction_management|cm",
        "construction_management",
        [],
    ),
    (
        "rule:safety_inspection",
        "safety_inspection|safety_check|performance_assessment",
        "structural_safety_inspection",
        [
            ("transportation", "traffic_safety_inspection"),
            ("harbor|pier|lock_facility", "harbor_safety_inspection"),
            (
                "dam|river|floodgate|reservoir|intake|pump_station|valve|water_supply",
                "water_resources_safety_inspection",
            ),
            ("railway|railway_track|high_speed", "railway_track_safety_inspection"),
        ],
    ),
    (
        "rule:impact_assessment",
        "impact_assessment",
        "environmental_impact_assessment",
        [
            ("disaster|protection", "disaster_impact_assessment"),
            ("transportation", "traffic_impact_assessment"),
            ("power", "power_impact_assessment"),
        ],
    ),
    ("rule:technical_inspection", "technical_inspection", "technical_inspection", []),
    ("rule:soil", "soil_pollution|soil_environment|soil_cleansing", "soil_survey", []),
]

# Scoring rules on the raw text, first hit wins. Each row lists the
# words, the labels tried in order against the model's probability, and the label
# taken when none of them is sure enough.
SCORING_RULES = [
    (["technical_inspection"], [], "technical_inspection"),
    (["disaster_protection"], [], "disaster_impact_assessment"),
    (
        ["supervision", "construction_management"],
        ["electrical_comm_fire_supervision"],
        "construction_management",
    ),
    (
        ["inspection", "check", "seismic_performance_assessment"],
        [
            "traffic_safety_inspection",
            "water_resources_safety_inspection",
            "railway_track_safety_inspection",
        ],
        "structural_safety_inspection",
    ),
    (
        ["impact_assessment"],
        ["power_impact_assessment", "traffic_impact_assessment", "disaster_impact_assessment"],
        "environmental_impact_assessment",
    ),
]
RULE_PROBABILITY = 0.65
MODEL_PROBABILITY = 0.6
UNCLASSIFIED = "unclassified"

# Status words.
CONFIRMED_ENSEMBLE = "auto_confirmed (ensemble)"
REVIEW_ENSEMBLE = "manual_review_needed (AI)"
CONFIRMED = "auto_confirmed"
REVIEW = "manual_review_needed"
INPUT_ERROR = "input error"
CLASSIFICATION_ERROR = "classification error"
PARSE_ERROR = "parse error"
JUDGE_NOT_SET = "LLM not set"
MATCH, MISMATCH, UNDETERMINED = "match", "mismatch", "undetermined"
VALIDATION_SKIPPED = "validation_skipped"
NO_KEYWORDS = "(keyword extraction failed)"

# Parameters.
ENSEMBLE_WEIGHTS = (0.9, 0.1)
CONFIDENCE_THRESHOLD = 0.9
SEED = 42
STOP_WORDS = ["service", "construction", "business", "for", "related", "misc", "and"]

# Code -> canonical field.
CODE_ROLLUP = {
    "structural_engineering": "structural",
    "geotechnical_engineering": "geotechnical",
    "geotechnical_2": "geotechnical",
    "geology": "geotechnical",
    "transportation_planning": "transportation",
    "road_engineering": "road",
    "road_engineering_legacy": "road",
    "railway_engineering": "railway",
    "railway_engineering_alt": "railway",
    "water_resources_1": "water_resources",
    "water_resources_2": "water_resources",
    "water_resources_3": "water_resources",
    "water_supply_main": "water_resources",
    "water_environment_1": "water_environment",
    "water_environment_2": "water_environment",
    "water_environment_3": "water_environment",
    "hydropower": "hydropower",
    "harbor_engineering": "harbor",
    "urban_planning": "urban_planning",
    "construction_management": "construction_management",
    "landscape_architecture": "landscape",
    "plant_engineering_1": "plant",
    "plant_engineering_2": "plant",
    "environmental_assessment": "environmental_assessment",
    "architecture": "architecture",
}

# Field -> labels (a label may sit under several fields).
TAXONOMY = {
    "construction_management": [
        "construction_management",
        "architecture_supervision",
        "electrical_comm_fire_supervision",
        "railway_supervision",
    ],
    "transportation": [
        "transportation_planning_system_design",
        "traffic_safety_inspection",
        "traffic_impact_assessment",
    ],
    "structural": ["structural_design", "structural_safety_inspection"],
    "road": ["road_design"],
    "urban_planning": ["urban_planning_land_development_design"],
    "water_environment": [
        "water_supply_design",
        "technical_inspection",
        "facility_operation_management",
    ],
    "water_resources": [
        "water_resources_river_design",
        "disaster_impact_assessment",
        "water_resources_safety_inspection",
    ],
    "hydropower": ["hydropower_design"],
    "landscape": ["landscape_forestry_design"],
    "geotechnical": ["geotechnical_tunnel_design", "soil_survey"],
    "railway": ["railway_design", "railway_supervision", "railway_track_safety_inspection"],
    "plant": [
        "electrical_comm_fire_supervision",
        "electrical_comm_design",
        "power_impact_assessment",
    ],
    "harbor": ["harbor_design", "harbor_safety_inspection"],
    "environmental_assessment": ["environmental_design", "environmental_impact_assessment"],
    "architecture": ["architectural_design"],
}
