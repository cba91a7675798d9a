from foldwise.plans.knn import nearest_neighbours
from foldwise.plans.pipeline import FeaturePlan, build_features
from foldwise.plans.profile import (
    analyze_target_by_feature, calculate_correlations, calculate_feature_summary, fold_score_summary,
    importance_summary, profile_tables, target_histogram, top_correlations, transform_impact,
)
from foldwise.plans.selection import (
    calculate_loo_feature_importance, evaluate_features_cv, select_features_backward, select_features_forward,
)
from foldwise.plans.stacking import train_stacking_meta_model, widen_predictions
from foldwise.plans.training import MODELS, CvResult, compare_models, train_and_cv, train_single_fold

__all__ = [
    "MODELS", "CvResult", "FeaturePlan", "analyze_target_by_feature", "build_features",
    "calculate_correlations", "calculate_feature_summary", "calculate_loo_feature_importance",
    "compare_models", "evaluate_features_cv", "fold_score_summary", "importance_summary",
    "nearest_neighbours", "profile_tables", "select_features_backward", "select_features_forward",
    "target_histogram", "top_correlations", "train_and_cv", "train_single_fold",
    "train_stacking_meta_model", "transform_impact", "widen_predictions",
]
