"""Small random tables for the tests."""

from __future__ import annotations

import numpy as np
import pandas as pd


def sample_frame(n: int = 200, seed: int = 42) -> pd.DataFrame:
    r = np.random.default_rng(seed)
    lim = {"avg_daily_distance_km": (1, 60), "travel_radius_km": (2, 100), "home_work_distance_km": (0.5, 50),
           "n_frequent_locations": (1, 10), "pct_time_at_home": (0.2, 0.9), "pct_time_at_work": (0.05, 0.4),
           "mobility_entropy": (0, 3), "data_usage_gb": (0.5, 80), "call_minutes_monthly": (0, 1000),
           "sms_monthly": (0, 300), "roaming_days_monthly": (0, 20), "morning_data_ratio": (0.1, 0.4),
           "afternoon_data_ratio": (0.1, 0.4), "evening_data_ratio": (0.1, 0.5), "night_data_ratio": (0.05, 0.3),
           "weekend_data_ratio": (0.15, 0.6), "peak_hour_data_ratio": (0.15, 0.6), "poi_office_score": (0, 1),
           "poi_transit_score": (0, 1), "poi_mall_score": (0, 1), "poi_residential_score": (0, 1),
           "poi_entertainment_score": (0, 1), "home_zone_rsrq": (-20, -5), "work_zone_rsrq": (-20, -5),
           "avg_throughput_mbps": (1, 100), "monthly_charges": (20, 150), "tenure_months": (1, 100)}
    pdf = pd.DataFrame({c: r.uniform(a, b, n) for c, (a, b) in lim.items()})
    pdf.insert(0, "subscriber_id", [f"SUB_{i:08d}" for i in range(n)])
    pdf["same_h3_zone"] = r.integers(0, 2, n)
    return pdf


def segmented_frame(n: int = 500, k: int = 5, seed: int = 42) -> pd.DataFrame:
    r = np.random.default_rng(seed)
    pdf = sample_frame(n, seed).drop(columns=["same_h3_zone"])
    seg = r.integers(0, k, n)
    pdf["segment_id"] = seg.astype("int32")
    for c, step in (("avg_daily_distance_km", 5), ("data_usage_gb", 8), ("call_minutes_monthly", 60)):
        pdf[c] = pdf[c] * 0.1 + seg * step
    pdf["true_persona_name"] = np.array(["Urban Commuter", "Home Office Pro", "Digital Nomad", "Social Hub",
                                         "Senior Steady"])[seg % 5]
    return pdf
