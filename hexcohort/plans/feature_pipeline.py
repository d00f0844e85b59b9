"""The whole feature plan: derive, select, impute, scale."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame

from hexcohort import constants as K
from hexcohort.operators.features import Mobility, PoiAffinity, TemporalUsage, Usage
from hexcohort.operators.poi_density import add_poi_density
from hexcohort.operators.scaling import Scale


def selected_features(columns: list[str]) -> list[str]:
    """Configured and engineered features that exist, in order, each once."""
    wanted = K.CLUSTERING_FEATURES + K.EXTRA_FEATURES
    return [c for c in dict.fromkeys(wanted) if c in columns]


DERIVED = ["home_work_ratio", "other_time_ratio", "mobility_ratio", "commute_intensity", "location_concentration",
           "business_leisure_ratio", "gb_per_dollar", "poi_work_affinity", "poi_leisure_affinity",
           "poi_stay_affinity", "poi_transit_affinity", "poi_diversity_score"]


def feature_stages(columns: list[str], scaler: str = "standard", with_usage: bool = False) -> list:
    features = selected_features(list(columns) + DERIVED)
    stages = [Mobility(), TemporalUsage(), PoiAffinity()]
    if with_usage:
        stages.append(Usage())
    return stages + [Scale(columns=features, method=scaler, impute=True)]


def fit_features(subs: DataFrame, pois: DataFrame | None = None, scaler: str = "standard",
                 with_usage: bool = False) -> tuple[PipelineModel, DataFrame]:
    """Fitted pipeline and the feature table (keys, raw and derived columns, ``features`` vector).

    POI density per home cell is added first when POIs are given.
    """
    if pois is not None:
        subs = add_poi_density(subs, pois)
    model = Pipeline(stages=feature_stages(subs.columns, scaler, with_usage)).fit(subs)
    return model, model.transform(subs)
