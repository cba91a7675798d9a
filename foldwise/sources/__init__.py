from foldwise.sources.files import create_data_samples, load_csv, load_parquet, save_csv, save_parquet
from foldwise.sources.models import load_model, save_model
from foldwise.sources.run_log import RUN_LOG_COLUMNS, load_run_log, update_run_log, update_stored_run_log
from foldwise.sources.stores import (
    generate_submission_file, load_folds, load_predictions, save_folds, save_model_artifacts, save_predictions,
)

__all__ = [
    "RUN_LOG_COLUMNS", "create_data_samples", "generate_submission_file", "load_csv", "load_folds",
    "load_model", "load_parquet", "load_predictions", "load_run_log", "save_csv", "save_folds", "save_model",
    "save_model_artifacts", "save_parquet", "save_predictions", "update_run_log", "update_stored_run_log",
]
