"""Fixed values of the data model.

These are fixed values: thresholds, word lists, catalog entries and feature
lists that must equal the published configuration for results to agree.
"""

from __future__ import annotations

# --- clustering features -------------------------------------------------
MOBILITY = ["avg_daily_distance_km", "travel_radius_km", "home_work_distance_km", "n_frequent_locations",
            "pct_time_at_home", "pct_time_at_work", "mobility_entropy"]
VOLUME = ["data_usage_gb", "call_minutes_monthly", "sms_monthly", "roaming_days_monthly"]
TEMPORAL = ["morning_data_ratio", "afternoon_data_ratio", "evening_data_ratio", "night_data_ratio",
            "weekend_data_ratio", "peak_hour_data_ratio"]
POI_SCORES = ["poi_office_score", "poi_transit_score", "poi_mall_score", "poi_residential_score",
              "poi_entertainment_score"]
NETWORK = ["home_zone_rsrq", "work_zone_rsrq", "avg_throughput_mbps"]
CLUSTERING_FEATURES = MOBILITY + VOLUME + TEMPORAL + POI_SCORES + NETWORK
EXTRA_FEATURES = ["home_work_ratio", "mobility_ratio", "commute_intensity", "location_concentration",
                  "business_leisure_ratio", "poi_work_affinity", "poi_leisure_affinity", "poi_stay_affinity",
                  "poi_diversity_score", "gb_per_dollar"]

CORRELATION_FEATURES = ["avg_daily_distance_km", "travel_radius_km", "home_work_distance_km", "data_usage_gb",
                        "call_minutes_monthly", "roaming_days_monthly", "morning_data_ratio",
                        "evening_data_ratio", "weekend_data_ratio", "poi_office_score", "poi_transit_score",
                        "poi_mall_score", "poi_residential_score", "home_zone_rsrq", "monthly_charges"]
HEATMAP_FEATURES = ["avg_daily_distance_km", "travel_radius_km", "data_usage_gb", "roaming_days_monthly",
                    "call_minutes_monthly", "evening_data_ratio", "weekend_data_ratio", "poi_office_score",
                    "poi_transit_score", "poi_mall_score", "poi_residential_score", "monthly_charges"]
RADAR_FEATURES = {"Mobility": "avg_daily_distance_km", "Data Usage": "data_usage_gb",
                  "Evening": "evening_data_ratio", "Weekend": "weekend_data_ratio",
                  "Work POI": "poi_office_score", "Leisure POI": "poi_mall_score",
                  "Roaming": "roaming_days_monthly", "Voice": "call_minutes_monthly"}
TIME_WINDOWS = {"Morning": "morning_data_ratio", "Afternoon": "afternoon_data_ratio",
                "Evening": "evening_data_ratio", "Night": "night_data_ratio"}
PROFILE_EXCLUDED = ["segment_id", "true_persona_id", "senior_citizen", "same_h3_zone", "is_home_worker",
                    "is_heavy_commuter", "is_frequent_traveler", "is_roamer"]

# --- bins ----------------------------------------------------------------
DATA_TIERS = [(5, "very_low"), (15, "low"), (30, "medium"), (60, "high"), (1000, "very_high")]
ARPU_TIERS = [(35, "budget"), (55, "standard"), (75, "mid"), (100, "premium"), (10000, "enterprise")]

# --- archetypes: feature -> direction, in declaration order ----------------
ARCHETYPES = {
    "Urban Commuter": {"avg_daily_distance_km": 1, "poi_transit_score": 1, "home_work_distance_km": 1,
                       "peak_hour_data_ratio": 1, "pct_time_at_home": -1, "data_usage_gb": 1},
    "Home Office Pro": {"pct_time_at_home": 1, "data_usage_gb": 1, "avg_daily_distance_km": -1,
                        "travel_radius_km": -1, "afternoon_data_ratio": 1, "poi_residential_score": 1},
    "Digital Nomad": {"travel_radius_km": 1, "roaming_days_monthly": 1, "n_frequent_locations": 1,
                      "mobility_entropy": 1, "pct_time_at_home": -1, "poi_transit_score": 1},
    "Weekend Explorer": {"weekend_data_ratio": 1, "avg_daily_distance_km": -1, "poi_entertainment_score": 1,
                         "poi_mall_score": 1, "morning_data_ratio": -1},
    "Social Hub": {"poi_mall_score": 1, "poi_entertainment_score": 1, "evening_data_ratio": 1,
                   "sms_monthly": 1, "n_frequent_locations": 1, "weekend_data_ratio": 1},
    "Senior Steady": {"call_minutes_monthly": 1, "data_usage_gb": -1, "avg_daily_distance_km": -1,
                      "pct_time_at_home": 1, "morning_data_ratio": 1, "poi_residential_score": 1},
    "Young Professional": {"poi_office_score": 1, "poi_entertainment_score": 1, "data_usage_gb": 1,
                           "evening_data_ratio": 1, "monthly_charges": 1, "tenure_months": -1},
}
# Own wording.
ARCHETYPE_DESCRIPTIONS = {
    "Urban Commuter": "Travels far every day, uses public transport and the network at rush hours.",
    "Home Office Pro": "Stays mostly at home and uses much data during the day.",
    "Digital Nomad": "Moves across many places, with a wide radius and frequent roaming.",
    "Weekend Explorer": "Quiet on weekdays, out for leisure and shopping on weekends.",
    "Social Hub": "Spends evenings and weekends in malls and entertainment venues, messages a lot.",
    "Senior Steady": "Moves little, calls a lot and uses hardly any data.",
    "Young Professional": "Works in office areas, goes out at night, spends more each month.",
}
UNKNOWN_SEGMENT = "Unknown Segment"
FALLBACK_DESCRIPTION = "Cohort found from movement and usage behaviour."
SCORING_FALLBACK_DESCRIPTION = "Behavioral segment"

# --- plans -----------------------------------------------------------------
ARCHETYPE_PLANS = {
    "Urban Commuter": ["unlimited_rush", "data_boost", "young_pro"],
    "Home Office Pro": ["home_pro", "unlimited_rush", "data_boost"],
    "Digital Nomad": ["nomad_global", "unlimited_rush", "data_boost"],
    "Weekend Explorer": ["weekend_explorer", "social_unlimited", "data_boost"],
    "Social Hub": ["social_unlimited", "young_pro", "weekend_explorer"],
    "Senior Steady": ["voice_classic", "weekend_explorer", "data_boost"],
    "Young Professional": ["young_pro", "unlimited_rush", "social_unlimited"],
}
FALLBACK_PLANS = ["data_boost", "young_pro", "unlimited_rush"]
# id, name, monthly price, tags, data GB, voice minutes, roaming, speed class
PLAN_CATALOG = [
    ("unlimited_rush", "Unlimited Rush", 85.0, ["unlimited", "priority", "commuter"], 999, 999, False, "priority"),
    ("home_pro", "Home Pro Broadband", 70.0, ["high_speed", "daytime", "work_from_home"], 500, 999, False, "high"),
    ("nomad_global", "Nomad Global", 95.0, ["roaming", "multi_zone", "traveler"], 50, 500, True, "standard"),
    ("weekend_explorer", "Weekend Explorer", 55.0, ["weekend", "leisure", "explorer"], 20, 200, False,
     "double_weekend"),
    ("social_unlimited", "Social Unlimited", 45.0, ["social", "streaming", "youth"], 999, 200, False, "social_only"),
    ("voice_classic", "Voice Classic", 35.0, ["voice", "senior", "simple"], 5, 1000, False, "standard"),
    ("young_pro", "Young Professional", 60.0, ["balanced", "streaming", "professional"], 20, 300, False, "standard"),
    ("data_boost", "Data Boost 50GB", 50.0, ["data_heavy", "budget", "flexible"], 50, 100, False, "high"),
]
PLAN_IDS = [p[0] for p in PLAN_CATALOG]
PLAN_NAMES = {p[0]: p[1] for p in PLAN_CATALOG}
PLAN_PRICES = {p[0]: p[2] for p in PLAN_CATALOG}
# Own wording; {name} is the segment.
PLAN_REASONS = {
    "unlimited_rush": "Priority data for the busy days of {name}",
    "home_pro": "Fast home line for the daytime load of {name}",
    "nomad_global": "Roaming in many zones for {name}",
    "weekend_explorer": "Double data on the weekends of {name}",
    "social_unlimited": "Open social apps for the evenings of {name}",
    "voice_classic": "Many minutes at a simple price for {name}",
    "young_pro": "Data with streaming extras for {name}",
    "data_boost": "Large data block for {name}",
}
FALLBACK_REASON = "Suggested for {name}"

# --- scoring request -----------------------------------------------------------
SCORE_DEFAULTS = {
    "avg_daily_distance_km": 10.0, "travel_radius_km": 15.0, "home_work_distance_km": 8.0,
    "n_frequent_locations": 3.0, "pct_time_at_home": 0.55, "pct_time_at_work": 0.22, "mobility_entropy": 1.5,
    "data_usage_gb": 15.0, "call_minutes_monthly": 300.0, "sms_monthly": 50.0, "roaming_days_monthly": 0.5,
    "morning_data_ratio": 0.25, "afternoon_data_ratio": 0.22, "evening_data_ratio": 0.30,
    "night_data_ratio": 0.18, "weekend_data_ratio": 0.30, "peak_hour_data_ratio": 0.35,
    "poi_office_score": 0.40, "poi_transit_score": 0.40, "poi_mall_score": 0.30, "poi_residential_score": 0.50,
    "poi_entertainment_score": 0.30, "home_zone_rsrq": -11.0, "work_zone_rsrq": -12.0,
    "avg_throughput_mbps": 25.0, "monthly_charges": 60.0, "tenure_months": 24.0,
}
SENIOR_DEFAULT = 0
# field -> (low, high); None is open
REQUEST_LIMITS = {
    **{c: (0.0, None) for c in ["avg_daily_distance_km", "travel_radius_km", "home_work_distance_km",
                                "mobility_entropy", "data_usage_gb", "call_minutes_monthly", "sms_monthly",
                                "roaming_days_monthly", "avg_throughput_mbps", "monthly_charges",
                                "tenure_months"]},
    "n_frequent_locations": (1.0, None),
    **{c: (0.0, 1.0) for c in ["pct_time_at_home", "pct_time_at_work"] + TEMPORAL + POI_SCORES},
    "senior_citizen": (0.0, 1.0),
}

# --- map colours -----------------------------------------------------------------
PALETTE = ["#e74c3c", "#3498db", "#9b59b6", "#2ecc71", "#f39c12", "#95a5a6", "#1abc9c", "#e67e22"]
NOISE_COLOUR = "#cccccc"

# --- places -----------------------------------------------------------------------
# south, west, north, east
CITY_BOXES = {
    "Jakarta": (-6.50, 106.60, -5.90, 107.10),
    "Surabaya": (-7.40, 112.55, -7.10, 112.85),
    "Bandung": (-6.98, 107.50, -6.83, 107.72),
    "Singapore": (1.20, 103.60, 1.48, 104.05),
    "Kuala Lumpur": (2.95, 101.55, 3.28, 101.85),
    "Bangkok": (13.55, 100.40, 13.95, 100.90),
    "Manila": (14.45, 120.85, 14.75, 121.20),
}
COUNTRY_MCC = {"ID": [510], "SG": [525], "MY": [502], "AU": [505], "GB": [234, 235], "US": [310, 311]}
COUNTRY_BOXES = {
    "ID": (-11.0, 95.0, 6.0, 141.0),
    "SG": (1.15, 103.6, 1.48, 104.1),
    "MY": (0.8, 99.6, 7.4, 119.3),
}
DEFAULT_BOX = (-11.0, 95.0, 6.0, 141.0)
# POI type -> tag key, pattern on its value
POI_RULES = {
    "office": ("office", None),
    "transit": ("public_transport", "station|stop_position"),
    "train_station": ("railway", "station|subway_entrance"),
    "mall": ("shop", "mall|department_store|supermarket"),
    "entertainment": ("amenity", "cinema|theatre|nightclub|bar|pub"),
    "restaurant": ("amenity", "restaurant|cafe|fast_food"),
    "education": ("amenity", "university|college|school"),
    "healthcare": ("amenity", "hospital|clinic|pharmacy"),
    "residential": ("place", "neighbourhood|suburb|residential"),
    "park": ("leisure", "park|garden|sports_centre"),
}
POI_TYPES = list(POI_RULES)
OFFICE_EXCLUDED = "diplomatic"
RADIO_GENERATION = {"GSM": "2G", "UMTS": "3G", "LTE": "4G", "NR": "5G"}
TOWER_COLUMNS = ["radio", "mcc", "net", "area", "cell", "unit", "lon", "lat", "range", "samples", "changeable",
                 "created", "updated", "averageSignal"]

# --- model settings ------------------------------------------------------------------
KMEANS_PARAMS = {"n_clusters": 7, "n_init": 20, "max_iter": 500, "seed": 42}
DBSCAN_PARAMS = {"eps": 0.5, "min_samples": 30}
HDB_PARAMS = {"min_cluster_size": 50, "min_samples": 10, "epsilon": 0.3}
K_RANGE = (5, 12)
MIN_SILHOUETTE = 0.30
DRIFT_LIMIT_PCT = 15.0
LOW_VARIANCE = 0.05
UPLIFT_SHARE = 0.15
