from foldwise.operators.aggregate import create_aggregation_features
from foldwise.operators.blend import average_predictions, stack_predictions, usable_models, weighted_blend
from foldwise.operators.cross import (
    add_feature_cross_terms, create_enhanced_interaction_features, create_interaction_features,
    create_n_way_multiplication_features, create_nway_interaction_features, create_polynomial_features,
)
from foldwise.operators.encode import (
    bin_and_encode_numerical_features, encode_categorical_features, fit_bins, fit_label, fit_onehot, fit_onehot_vector,
    fit_ordinal,
)
from foldwise.operators.encode_stats import (
    apply_count_encoding, apply_ratio_to_category_mean_encoding, apply_target_encoding, fit_count_encoder,
    fit_ratio_encoder, fit_target_encoder,
)
from foldwise.operators.fold_relation import (
    check_relation, expanding_folds, fit_relation_target_encoder, folds_of_conditions, relation_of_folds, repeated_folds,
)
from foldwise.operators.folds import (
    assign_folds, contiguous_kfold, fold_pairs, group_kfold, kfold, stratified_kfold,
)
from foldwise.operators.impute import fit_imputer, handle_missing_values
from foldwise.operators.lattice import fit_crossed_encoder
from foldwise.operators.lookup import map_column
from foldwise.operators.metrics import calculate_metric, evaluate
from foldwise.operators.ordered_stats import fit_ordered_target_encoder
from foldwise.operators.sample import (
    drop_duplicates_keep_first, head_rows, sample_dataframe, take_split, union_splits, with_row_index,
)
from foldwise.operators.scale import fit_scaler, scale_numerical_features
from foldwise.operators.schema_ops import (
    add_missing_target, check_values, coerce_schema, compact_schema, drop_null_target, require_target,
)
from foldwise.operators.target import (
    apply_target_transformation, clip_predictions, denormalize_predictions_by_feature, fit_target_transform, normalize_target_by_feature,
    reverse_target_transformation,
)

__all__ = [
    "add_feature_cross_terms", "add_missing_target", "apply_count_encoding",
    "apply_ratio_to_category_mean_encoding", "apply_target_encoding", "apply_target_transformation", "assign_folds", "average_predictions",
    "bin_and_encode_numerical_features", "calculate_metric", "check_relation", "check_values", "clip_predictions",
    "coerce_schema", "compact_schema", "contiguous_kfold", "create_aggregation_features",
    "create_enhanced_interaction_features", "create_interaction_features",
    "create_n_way_multiplication_features", "create_nway_interaction_features",
    "create_polynomial_features", "denormalize_predictions_by_feature", "drop_duplicates_keep_first",
    "drop_null_target", "encode_categorical_features", "evaluate", "expanding_folds", "fit_bins", "fit_count_encoder", "fit_crossed_encoder",
    "fit_imputer", "fit_label", "fit_onehot", "fit_onehot_vector", "fit_ordered_target_encoder", "fit_ordinal",
    "fit_ratio_encoder", "fit_relation_target_encoder", "fit_scaler",
    "fit_target_encoder", "fit_target_transform", "fold_pairs", "folds_of_conditions", "group_kfold", "handle_missing_values",
    "head_rows", "kfold", "map_column", "normalize_target_by_feature", "relation_of_folds", "repeated_folds", "require_target", "reverse_target_transformation",
    "sample_dataframe", "scale_numerical_features", "stack_predictions", "stratified_kfold", "take_split",
    "union_splits", "usable_models", "weighted_blend", "with_row_index",
]
