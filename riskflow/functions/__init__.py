from .features import (GOLD, ONLINE, PRESETS, STORE, FeatureSpec, feature_columns,
                       gold_features, model_input_columns, online_features, rule_score,
                       rule_tier, rule_tier_rate, store_features)
from .scalars import flag, hour_from_text, md5_prefix_int, pct_change

__all__ = ["GOLD", "ONLINE", "PRESETS", "STORE", "FeatureSpec", "feature_columns",
           "gold_features", "model_input_columns", "online_features", "rule_score", "rule_tier",
           "rule_tier_rate", "store_features", "flag", "hour_from_text",
           "md5_prefix_int", "pct_change"]
