"""Preparation chains shared by the classification / anomaly / spectral runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from astroframe.constants import FEATURES_ALL, FEATURES_ENGINEERED, FEATURES_ORBITAL, MIN_CLASS_COUNT
from astroframe.models.prep import assemble_features, impute_median, standardize
from astroframe.operators.classify import label_encode, label_list
from astroframe.operators.clean import available
from astroframe.operators.joins import semi_valid_classes
from astroframe.operators.sampling import stratified_split
from astroframe.session import checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    """Write the frame once to the shared checkpoint folder and cut its lineage.

    Every later pass (quantiles, moments, split thresholds, training
    iterations) then reads these files instead of recomputing the ETL, and
    a lost executor re-reads them instead of replaying the whole plan.
    The rows are dealt evenly first: a compressed table is read by few tasks,
    and each of the written parts is a later task's whole input.
    """
    checkpoint_dir(df.sparkSession)
    return df.hint("rebalance").checkpoint(eager=True)

CLASSIFY_FEATURES = FEATURES_ALL + FEATURES_ENGINEERED
ANOMALY_FEATURES = FEATURES_ORBITAL + FEATURES_ENGINEERED


def encode_labels(df: DataFrame, col: str) -> tuple[DataFrame, list]:
    """Alphabetical 0-based codes joined from a written code table; also returns the class list."""
    classes = label_list(df, col)
    return label_encode(df, col, "label"), classes


def classification_frame(processed: DataFrame, id_col: str = "spkid", label_col: str = "object_type",
                         cols: Sequence[str] = CLASSIFY_FEATURES, test: float = 0.2, seed: int = 42,
                         min_count: int = MIN_CLASS_COUNT):
    """Valid classes -> exact-median impute -> population scaling -> codes -> stratified split.

    Imputer and scaler are fitted on all valid rows before the split, as in
    the reference.  Returns (train, test, feature names, class names).
    """
    cols = available(processed, cols)
    df = semi_valid_classes(processed.where(F.col(label_col).isNotNull()), label_col, min_count)
    df = materialize(df.select(id_col, label_col, "full_name", *cols))
    df = standardize(impute_median(df, cols), cols)
    df, classes = encode_labels(df, label_col)
    df = stratified_split(df, label_col, id_col, test, seed)
    df = materialize(assemble_features(df, cols))
    return df.where(F.col("split") == "train"), df.where(F.col("split") == "test"), cols, classes


def anomaly_frame(processed: DataFrame, id_col: str = "spkid", cols: Sequence[str] = ANOMALY_FEATURES):
    """All rows, imputed and scaled on the orbital + engineered features."""
    cols = available(processed, cols)
    df = materialize(processed.select(id_col, "full_name", "object_type", *cols))
    return assemble_features(standardize(impute_median(df, cols), cols), cols), cols


def spectral_frame(galaxies: DataFrame, id_col: str = "gal_id", test: float = 0.2, seed: int = 42):
    """Redshift bins as classes, scaled colours, stratified split."""
    from astroframe.constants import REDSHIFT_EDGES, REDSHIFT_LABELS, SDSS_FEATURES
    from astroframe.operators.classify import cut_bins

    cols = list(SDSS_FEATURES)
    df = cut_bins(galaxies, "redshift", REDSHIFT_EDGES, REDSHIFT_LABELS, "spectral_class")
    df = materialize(df.select(id_col, "spectral_class", *cols))
    df = standardize(df, cols)
    df, classes = encode_labels(df, "spectral_class")
    df = stratified_split(df, "spectral_class", id_col, test, seed)
    df = materialize(assemble_features(df, cols))
    return df.where(F.col("split") == "train"), df.where(F.col("split") == "test"), cols, classes
