from ontime.operators.charts import (
    bar_counts,
    bar_counts_many,
    heatmap_long,
    histogram_unit,
    roc_chart,
    scatter_grid,
)
from ontime.operators.derive import add_label, add_season, add_time_of_day, add_times_of_day
from ontime.operators.dictionary import category_dictionary, dictionary_sizes, index_by_dictionary
from ontime.operators.encode import (
    EncodedSplit,
    feature_names,
    feature_pipeline,
    fit_features,
    min_max,
    one_hot,
    string_indexer,
    trim_raw,
)
from ontime.operators.evaluate import (
    auc,
    auc_exact,
    classification_metrics,
    compare_fitted,
    compare_models,
    evaluate_models,
    confusion_matrix,
    roc_curves,
    roc_points,
    score_models,
)
from ontime.operators.filters import (
    at_least,
    count_where,
    drop_nulls,
    has_values,
    keep_at_least,
    row_count,
    row_count_audit,
    sample_rows,
)
from ontime.operators.models import (
    best_params,
    coefficients,
    default_grid,
    grid_estimator,
    grid_scores,
    model_params,
    named_coefficients,
    named_importances,
    param_grid,
    param_table,
    predict,
    train_forest,
    train_logistic,
    with_score,
)
from ontime.operators.profile import (
    cell_counts,
    columns_with_nulls,
    describe_numeric,
    distinct_count,
    duplicate_count,
    fill_missing,
    non_null_counts,
    null_counts,
    profile,
    profile_categorical,
    profile_numeric,
    rows_with_nulls,
    shape_profile,
    value_counts,
)
from ontime.operators.projection import (
    cast_columns,
    cast_where,
    columns_by_type,
    drop_columns,
    is_object_type,
    select_columns,
)
from ontime.operators.ranking import arg_best, bottom_k, preview, top_bottom, top_k
from ontime.operators.running import exact_percentiles, running_totals
from ontime.operators.sketches import column_sketches, merge_sketches, sketched_profile
from ontime.operators.split import assign_parts, hash_split, random_split, score_linear
from ontime.operators.stats import (
    chi_square,
    chi_square_named,
    chi_square_onehot,
    chi_square_table,
    corr_matrix,
    corr_matrix_wide,
    slot_cells,
)
from ontime.operators.tuning import fold_areas, grid_search, write_folds

__all__ = [name for name in dir() if not name.startswith("_")]
