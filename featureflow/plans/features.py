"""Feature pipeline.

``static_features``   deterministic cleaning: join, drop, filter, cast, clock and
                      calendar encodings (no learned state)
``FeatureEstimator``  learns imputation values, frequent values, encoder choice,
                      mean-target tables and one-hot labels
``FeatureModel``      applies them: row count unchanged, one projection plus
                      JVM-side ml stages; persisted through Spark's ML writer
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.functions.columns import lookup
from featureflow.functions.time import cyclic_pair, month_length
from featureflow.operators import clean, encode, frequent, impute
from featureflow.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, join_dimension
from featureflow.operators.sampling import is_train
from featureflow.session import setting
from featureflow.spec import Cyclic, FeatureSpec


# ---------------------------------------------------------------- spec (de)serialisation
def spec_to_json(spec: FeatureSpec) -> str:
    return json.dumps(asdict(spec))


def spec_from_json(text: str) -> FeatureSpec:
    d = json.loads(text)
    d["cyclic"] = tuple(Cyclic(**c) for c in d.get("cyclic", ()))
    for k in ("dim_renames", "derived"):
        d[k] = tuple(tuple(x) for x in d.get(k, ()))
    for k in ("forbidden", "useless", "quantitative", "hhmm", "nominal", "sentinels", "keep"):
        d[k] = tuple(d.get(k, ()))
    if d.get("exclude") is not None:
        d["exclude"] = tuple(d["exclude"])
    return FeatureSpec(**d)


# ---------------------------------------------------------------- C1 static preprocessing
def cyclic_columns(df: DataFrame, cyclic) -> DataFrame:
    """``<name>_cos`` / ``<name>_sin`` for every calendar column, one projection."""
    exprs = {}
    for c in cyclic:
        period = month_length(c.month_col) if c.month_col else c.period
        cos, sin = cyclic_pair(c.name, period)
        exprs[f"{c.name}_cos"] = cos
        exprs[f"{c.name}_sin"] = sin
    return df.withColumns(exprs) if exprs else df


def static_features(fact: DataFrame, dim: DataFrame | None, spec: FeatureSpec,
                    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                    salt_buckets: int = 0, heavy_share: float | None = None) -> DataFrame:
    """fact JOIN dim, leakage and useless columns dropped, cancelled rows out,
    numbers cast (bad text -> NULL), rows without label out, clock values to
    minutes, calendar values to (cos, sin).

    The row filter and the column pruning run before the join so that both
    reach the fact scan; the calendar source columns are kept for imputation.
    """
    df = clean.drop_columns(fact, spec.forbidden)
    if spec.derived:
        df = df.withColumns({name: F.expr(expr) for name, expr in spec.derived})
    if spec.exclude is not None:
        df = clean.exclude_value(df, spec.exclude[0], spec.exclude[1])
    if dim is not None:
        d = clean.rename_columns(clean.drop_columns(dim, spec.forbidden), spec.dim_renames)
        # what is dropped after the join must not count in the broadcast's size
        unused = [c for c in spec.useless if c != spec.key]
        df = join_dimension(clean.drop_columns(df, unused), clean.drop_columns(d, unused), spec.key, "inner",
                            max_broadcast_rows, salt_buckets, heavy_share)
    df = clean.drop_columns(df, spec.useless)
    casts = {c: F.col(c).try_cast(spec.cast_type) for c in spec.quantitative if c in df.columns}
    casts[spec.label] = F.col(spec.label).try_cast(spec.label_type)
    df = df.withColumns(casts)
    df = df.filter(F.col(spec.label).isNotNull())
    df = clean.hhmm_columns(df, spec.hhmm)
    return cyclic_columns(df, spec.cyclic)


# ---------------------------------------------------------------- C2 / C3 learned stage
class _StateParams(Params):
    state = Param(Params._dummy(), "state", "learned parameters as JSON", TypeConverters.toString)
    specJson = Param(Params._dummy(), "specJson", "FeatureSpec as JSON", TypeConverters.toString)

    def spec(self) -> FeatureSpec:
        return spec_from_json(self.getOrDefault(self.specJson))


class _FitParams(_StateParams):
    frequencyThreshold = Param(Params._dummy(), "frequencyThreshold", "share of the rows a kept value must exceed, > 0",
                               TypeConverters.toFloat)
    cardinalityThreshold = Param(Params._dummy(), "cardinalityThreshold", "one-hot up to so many slots",
                                 TypeConverters.toInt)
    highCardinalityStrategy = Param(Params._dummy(), "highCardinalityStrategy", "mean or ignore",
                                    TypeConverters.toString)
    relativeError = Param(Params._dummy(), "relativeError", "rank error of the medians, 0 for exact ones",
                          TypeConverters.toFloat)
    persistInput = Param(Params._dummy(), "persistInput", "persist the columns to learn from while learning",
                         TypeConverters.toBoolean)


class FeatureEstimator(Estimator, _FitParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns all dynamic preprocessing parameters from the training rows.

    The columns to learn from are persisted while learning (unless the caller
    persisted its rows: ``persist_input=False``).  Medians of all numeric
    columns come from KLL sketches merged in two levels (or exact binning
    passes).  Modes, frequent values and their label sums of all categorical
    columns come from one multistage filter (``operators.frequent``): at most
    1/threshold + 1 values a feature are kept, all other rows are counted as
    "Other" without their values ever being shuffled.  Imputation, encoder
    choice, one-hot labels and mean-target tables are derived from those counts:
    categories are imputed *before* encoders are fitted, so encoders never hold
    a NULL group.  The settings are params: they
    are saved with the estimator and ``fit(df, {param: value})`` overrides them.
    A numeric column without any value in the training rows is an error.
    """

    def __init__(self, spec: FeatureSpec | None = None, frequency_threshold: float = 0.02,
                 cardinality_threshold: int = 10, high_cardinality_strategy: str = "mean",
                 relative_error: float | None = 0.025, persist_input: bool = True):
        super().__init__()
        self._set(frequencyThreshold=frequency_threshold, cardinalityThreshold=cardinality_threshold,
                  highCardinalityStrategy=high_cardinality_strategy, relativeError=relative_error or 0.0,
                  persistInput=persist_input)
        self._threshold()
        if spec is not None:
            self._set(specJson=spec_to_json(spec))

    def _threshold(self) -> float:
        threshold = self.getOrDefault(self.frequencyThreshold)
        if not threshold > 0:
            # the learned tables are bounded by 1/threshold values per feature;
            # without a threshold use encode.mean_target_table / mean_encode,
            # which keep the table as a DataFrame and join it
            raise ValueError("frequency_threshold must be > 0")
        return threshold

    def _fit(self, df: DataFrame) -> "FeatureModel":
        spec = self.spec()
        threshold = self._threshold()
        quant = [c for c in spec.quantitative_out if c in df.columns]
        calendar = [c.name for c in spec.cyclic if c.name in df.columns]
        nominal = [c for c in spec.nominal if c in df.columns]
        cats = calendar + nominal

        # the learned columns only, computed once: quantiles and counts make several passes
        kept = df.select(*dict.fromkeys([*quant, *cats, spec.label]))
        if self.getOrDefault(self.persistInput):
            kept.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            medians = impute.learn_medians(kept, quant, self.getOrDefault(self.relativeError) or None)
            unknown = [c for c, v in medians.items() if v is None]
            if unknown:
                raise ValueError(f"no value in the training rows to learn a median from: {unknown}")
            data = impute.with_sentinels_as_null(kept, cats, spec.sentinels)
            counted = frequent.frequent_counts(data, cats, threshold, spec.label, modes=True)
        finally:
            kept.unpersist()

        # categories are imputed in the counts: the NULL group joins its feature's mode
        buckets = {f: counted[f].imputed().bucketed(threshold, encode.OTHER) for f in nominal}
        values = {f: counted[f].imputed().frequent(threshold) for f in nominal}
        kinds = encode.encoder_choice(values, self.getOrDefault(self.cardinalityThreshold),
                                      self.getOrDefault(self.highCardinalityStrategy))
        labels, means = {}, {}
        for f in nominal:
            if kinds[f] == "binary":
                labels[f] = encode.index_labels_from_counts({v: c.n for v, c in buckets[f].items()})
            elif kinds[f] == "mean":
                means[f] = {v: c.label_sum / c.label_n for v, c in buckets[f].items() if c.label_n}
                if encode.OTHER not in means[f]:
                    every = sum(buckets[f].values(), frequent.Counts())
                    means[f][encode.OTHER] = every.label_sum / every.label_n if every.label_n else None

        state = {
            "fills": {**medians, **{c: counted[c].mode for c in cats}},
            "sentinel_columns": cats,
            "frequent": values,
            "kinds": kinds,
            "labels": labels,
            "means": means,
            "quantitative": quant,
            "calendar": calendar,
        }
        model = FeatureModel()
        model._set(specJson=self.getOrDefault(self.specJson), state=json.dumps(state))
        return model


class FeatureModel(Model, _StateParams, DefaultParamsReadable, DefaultParamsWritable):
    """Applies learned parameters; the row count never changes."""

    def __init__(self):
        super().__init__()

    @property
    def params_dict(self) -> dict:
        return json.loads(self.getOrDefault(self.state))

    def feature_columns(self) -> list[str]:
        """Vector layout: quantitative, then encoded nominal, then ordinal (sin, cos)."""
        st = self.params_dict
        spec = self.spec()
        nominal = []
        for f in spec.nominal:
            kind = st["kinds"].get(f)
            if kind == "binary":
                nominal.append(f"{f}_binary")
            elif kind == "mean":
                nominal.append(f"{f}_mean_enc")
        return list(st["quantitative"]) + nominal + spec.ordinal_out

    def _transform(self, df: DataFrame) -> DataFrame:
        st = self.params_dict
        spec = self.spec()
        cats = [c for c in st["sentinel_columns"] if c in df.columns]
        df = impute.apply_imputation(df, st["fills"], cats, spec.sentinels)
        # calendar columns were imputed above: re-derive their (cos, sin) pairs
        df = cyclic_columns(df, [c for c in spec.cyclic if c.name in st["calendar"]])
        df = encode.rare_to_other(df, st["frequent"])
        df = encode.one_hot(df, st["labels"], suffix_in="_aggregated")
        means = {f"{f}_mean_enc": lookup(F.col(f"{f}_aggregated"), {k: v for k, v in m.items() if k is not None},
                                         default=m.get(encode.OTHER))
                 for f, m in st["means"].items()}
        if means:
            df = df.withColumns(means)
        return assemble(df, self.feature_columns())


def assemble(df: DataFrame, columns, output: str = "features") -> DataFrame:
    """Numeric columns as one vector; a NULL is an error, never a dropped row."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error").transform(df)


# ---------------------------------------------------------------- C4 - C7 orchestration
def path_exists(spark, path: str) -> bool:
    """Existence test through the Hadoop FileSystem of the path (any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def list_dirs(spark, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def fit_or_load(df: DataFrame, spec: FeatureSpec, params_path: str | None = None,
                refit: bool = False, **estimator_kw) -> FeatureModel:
    """Fit the feature stage, or reuse the one saved at ``params_path``."""
    spark = df.sparkSession
    if params_path and not refit and path_exists(spark, params_path):
        return FeatureModel.load(params_path)
    model = FeatureEstimator(spec, **estimator_kw).fit(df)
    if params_path:
        model.write().overwrite().save(params_path)
    return model


SPLIT = "is_train"


def flag_split(fact: DataFrame, train_frac: float = 0.8, seed: int = 42, split_key: str | None = None) -> DataFrame:
    """``fact`` with the BOOLEAN column ``is_train``: by a hash of ``split_key`` (the same on any layout),
    else by ``rand(seed)`` (reproducible for a fixed input layout)."""
    if SPLIT in fact.columns:
        raise ValueError(f"the fact already has a column {SPLIT!r}")
    return fact.withColumn(SPLIT, is_train(split_key, train_frac) if split_key else F.rand(seed) < F.lit(train_frac))


def split_fit_apply(fact: DataFrame, dim: DataFrame | None, spec: FeatureSpec, train_frac: float = 0.8,
                    seed: int = 42, params_path: str | None = None, refit: bool = True,
                    split_key: str | None = None, **estimator_kw):
    """Split first (no leakage), learn on the training rows, apply to both.

    Both splits are one flagged table through one join; (train, test, model) are
    returned lazily.  ``build_feature_table`` writes both in one scan.
    """
    static = static_features(flag_split(fact, train_frac, seed, split_key), dim, spec)
    model = fit_or_load(static.filter(SPLIT).drop(SPLIT), spec, params_path, refit=refit, **estimator_kw)
    out = model.transform(static)
    return out.filter(SPLIT).drop(SPLIT), out.filter(~F.col(SPLIT)).drop(SPLIT), model


def preprocess_new(fact: DataFrame, dim: DataFrame | None, spec: FeatureSpec, model: FeatureModel) -> DataFrame:
    """Preprocess new rows with saved parameters (static + learned)."""
    return model.transform(static_features(fact, dim, spec))


def build_feature_table(fact: DataFrame, dim: DataFrame | None, spec: FeatureSpec, out_dir: str,
                        params_path: str | None = None, train_frac: float = 0.8, seed: int = 42,
                        split_key: str | None = None, reuse: bool = True, **estimator_kw):
    """Write the feature table (partitions is_train=true and false) to Parquet once; later calls read it.

    The schema travels inside Parquet itself; the stored tables are the lineage
    cut for the training job.
    """
    spark = fact.sparkSession
    path = f"{out_dir}/features.parquet"
    # _SUCCESS is written last: a folder without it is unfinished and built again
    if reuse and path_exists(spark, f"{path}/_SUCCESS"):
        return read_feature_table(spark, out_dir)
    # one scan of the fact and one join: learning and applying read the persisted static rows
    static = static_features(flag_split(fact, train_frac, seed, split_key), dim, spec).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = fit_or_load(static.filter(SPLIT).drop(SPLIT), spec, params_path or f"{out_dir}/params", refit=True,
                            persist_input=False, **estimator_kw)
        # two open files a task instead of a sort of all rows by the split
        with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "2"):
            model.transform(static).write.mode("overwrite").partitionBy(SPLIT).parquet(path)
    finally:
        static.unpersist()
    return read_feature_table(spark, out_dir)


def read_feature_table(spark, out_dir: str) -> tuple[DataFrame, DataFrame]:
    """(train, test) of a feature table: two partitions of one Parquet table."""
    table = spark.read.parquet(f"{out_dir}/features.parquet")
    flag = F.col(SPLIT).cast("boolean")
    return table.filter(flag).drop(SPLIT), table.filter(~flag).drop(SPLIT)
