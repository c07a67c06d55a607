"""Classifiers: parameter grids, the train cycle over ratios and pipelines, scoring, and saving."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import product

from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from minespark.operators import evaluate, prep
from minespark.operators.stats import PSI_LIMIT, band_counts, psi, require

ALGORITHMS = {"logistic": LogisticRegression, "forest": RandomForestClassifier, "boosted": GBTClassifier, "tree": DecisionTreeClassifier}
SCORE_BANDS = tuple(range(0, 101, 10))


def grid(algorithm: str, params: Mapping[str, Sequence] | None = None) -> dict[str, object]:
    """Named unfitted models of every parameter combination."""
    keys = list(params or {})
    out = {}
    for values in product(*(params[k] for k in keys)) if keys else [()]:
        p = dict(zip(keys, values))
        out["_".join([algorithm, *(f"{k}={v}" for k, v in p.items())])] = ALGORITHMS[algorithm](featuresCol="features", labelCol="y", **p)
    return out


def default_models() -> dict[str, object]:
    """A regularised regression, two forests and two boosted ensembles, one of which drops rows and columns at random for each tree."""
    boosted = grid("boosted", {"maxIter": [30], "maxDepth": [4], "seed": [1]}) | grid("boosted", {"maxIter": [60], "maxDepth": [4], "stepSize": [0.05], "subsamplingRate": [0.7], "featureSubsetStrategy": ["onethird"], "seed": [1]})
    return grid("logistic", {"regParam": [0.01]}) | grid("forest", {"numTrees": [50], "maxDepth": [4, 8], "seed": [1]}) | boosted


def fit_shared(df: DataFrame, numbers: Sequence[str], categories: Sequence[str], label: str, positive: str, negative: str, kinds: Sequence[str], *, freq_limit: float = 0.95, unique_limit: int = 5000, valuecount_limit: int = 50) -> tuple[list[prep.Fitted], prep.Fitted | None]:
    """What preparations of these kinds have in common, fitted once: the filter and imputation of all, and the bins of 'woe' and 'binned'."""
    steps = prep.fit_prefilter(df, numbers, categories, freq_limit=freq_limit, unique_limit=unique_limit, valuecount_limit=valuecount_limit)
    numbers, categories = (prep.needed_columns(steps, c) for c in (numbers, categories))
    if categories:
        steps.append(prep.fit_impute(df, categories, "constant", "unknown"))
    bins = prep.fit_mdlp(prep.apply_all(steps, df), numbers, label, positive, negative, drop_unsplit=True) if numbers and {"woe", "binned"} & set(kinds) else None
    return steps, bins


def fit_pipeline(df: DataFrame, numbers: Sequence[str], categories: Sequence[str], label: str, positive: str, negative: str, *, kind: str = "woe", freq_limit: float = 0.95, unique_limit: int = 5000, valuecount_limit: int = 50, iv_limit: float = 0.02, r_limit: float = 0.8, shared: tuple[list[prep.Fitted], prep.Fitted | None] | None = None) -> list[prep.Fitted]:
    """Preparation of one kind: 'woe' (bins, then WOE of all), 'scaled' (scaled numbers, indicators of categories), 'binned' (bins and categories as indicators).

    `shared` has what is fitted already (fit_shared).
    """
    common, bins = shared or fit_shared(df, numbers, categories, label, positive, negative, [kind], freq_limit=freq_limit, unique_limit=unique_limit, valuecount_limit=valuecount_limit)
    steps = list(common)
    numbers, categories = (prep.needed_columns(steps, c) for c in (numbers, categories))
    cur = prep.apply_all(steps, df)

    def add(step: prep.Fitted) -> None:
        nonlocal cur
        steps.append(step)
        cur = step.apply(cur)

    if kind == "scaled":
        if numbers:
            add(prep.fit_impute(cur, numbers, "constant", 0))
            add(prep.fit_scale(cur, numbers))
        if categories:
            add(prep.fit_onehot(cur, categories, label=label, positive=positive, negative=negative, iv_limit=0.0, limit=max(5000, unique_limit)))
        return steps
    if numbers:
        add(bins)
        numbers = [c for c in numbers if c in cur.columns]
    if kind == "woe":
        step, _ = prep.fit_woe(cur, [*numbers, *categories], label, positive, negative, iv_limit=iv_limit, r_limit=r_limit, keep_r=True, limit=max(5000, unique_limit))
        add(step)
    elif kind == "binned":
        add(prep.fit_onehot(cur, [*numbers, *categories], label=label, positive=positive, negative=negative, iv_limit=0.0, limit=max(5000, unique_limit)))
    else:
        raise ValueError(f"no kind {kind}")
    return steps


def features_of(steps: Sequence[prep.Fitted], df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Model inputs after the steps: what is left of the columns, and the indicators made of them."""
    out = prep.apply_all(steps, df.limit(0)).columns
    made = {f"{c}~{v}" for s in steps if s.kind == "onehot" for c, r in s.rules.items() for v in r["values"]}
    return [c for c in out if c in columns or c in made]


@dataclass
class Trained:
    """A model with its preparation, inputs, evaluation tables, and of the first data set the thresholds and the rows in each score band."""

    name: str
    steps: list[prep.Fitted]
    inputs: list[str]
    model: Model
    label: tuple[str, str, str]
    tables: dict[str, list] = field(default_factory=dict)
    psi: float | None = None
    thresholds: list[float] = field(default_factory=list)
    bands: list[tuple[int, int]] = field(default_factory=list)

    def score(self, df: DataFrame) -> DataFrame:
        """df with score = 100 x probability, to three digits. Columns it lacks count as missing."""
        ready = prep.apply_all(self.steps, prep.with_missing(df.withColumn("_row", F.struct(*(F.col(f"`{c}`") for c in df.columns))), [c for s in self.steps for c in s.rules if "~" not in c]))
        names = [f"f{i}" for i in range(len(self.inputs))]
        vectors = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep").transform(ready.select("_row", *(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(n) for c, n in zip(self.inputs, names))))
        p = vector_to_array(F.col("probability"))[1]
        return self.model.transform(vectors).select("_row.*", F.round(p * 100, 3).alias("score"))

    def importances(self, comments: Mapping[str, str] | None = None, most: int | None = None) -> list[tuple]:
        """(input, importance[, comment of its field]), greatest first; the first `most` of them."""
        raw = self.model.featureImportances.toArray() if hasattr(self.model, "featureImportances") else self.model.coefficients.toArray()
        found = sorted(zip(self.inputs, map(float, raw)), key=lambda x: (-abs(x[1]), x[0]))[:most]
        return found if comments is None else [(c, x, comments.get(c, comments.get(c.split("~")[0].split("__")[-1], ""))) for c, x in found]

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        meta = {"name": self.name, "kind": type(self.model).__name__, "steps": [s.to_json() for s in self.steps], "inputs": self.inputs, "label": self.label, "psi": self.psi, "thresholds": self.thresholds, "bands": self.bands, "tables": {n: [r.asDict() for r in t] for n, t in self.tables.items()}}
        spark = SparkSession.active()
        spark.createDataFrame([(json.dumps(meta, ensure_ascii=False),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @staticmethod
    def load(path: str) -> Trained:
        import pyspark.ml.classification as c

        meta = json.loads(SparkSession.active().read.text(f"{path}/meta").first()[0])
        model = getattr(c, meta["kind"]).load(f"{path}/model")
        tables = {n: [Row(**r) for r in t] for n, t in meta.get("tables", {}).items()}
        return Trained(meta["name"], [prep.Fitted.from_json(s) for s in meta["steps"]], meta["inputs"], model, tuple(meta["label"]), tables, meta["psi"], meta["thresholds"], [tuple(b) for b in meta.get("bands", [])])


def train_one(df: DataFrame, steps: list[prep.Fitted], estimator, name: str, columns: Sequence[str], label: tuple[str, str, str], *, nulls: str = "zero") -> Trained:
    """A fitted model. Nulls that the steps leave in the inputs count as 0, or are an error that names the columns (nulls="error")."""
    if nulls not in ("zero", "error"):
        raise ValueError(f"nulls {nulls}")
    col, positive, negative = label
    y = F.col(col).cast("string")
    rows = df.where(y.isin(positive, negative)).withColumn("y", (y == positive).cast("double"))
    inputs = features_of(steps, df, columns)
    if not inputs:
        raise ValueError(f"{name}: no inputs are left")
    ready = prep.apply_all(steps, rows)
    if nulls == "error":
        require(ready, {c: F.col(f"`{c}`").isNotNull() for c in inputs})
    names = [f"f{i}" for i in range(len(inputs))]
    vectors = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep").transform(ready.select("y", *(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(n) for c, n in zip(inputs, names))))
    return Trained(name, steps, inputs, estimator.fit(vectors), label)


def cycle(train: DataFrame, sets: Mapping[str, DataFrame], *, numbers: Sequence[str], categories: Sequence[str], label: tuple[str, str, str], ratios: Sequence = ("actual",), kinds: Sequence[str] = ("woe",), models: Mapping[str, object] | None = None, key, positive_limit: int = 10_000, stratified: str | None = None, null_label: str = "del", **how) -> dict[str, Trained]:
    """All combinations of ratio, preparation and model, each with an evaluation table per data set and the bands' stability between the first two."""
    from minespark.operators.sampling import down_sample

    col, positive, negative = label
    out = {}
    for ratio in ratios:
        sample = down_sample(train, label=col, positive=positive, negative=negative, positive_limit=positive_limit, ratio=ratio, key=key, stratified=stratified).cache()
        shared = fit_shared(sample, numbers, categories, col, positive, negative, kinds, **{k: v for k, v in how.items() if k in ("freq_limit", "unique_limit", "valuecount_limit")})
        for kind in kinds:
            steps = fit_pipeline(sample, numbers, categories, col, positive, negative, kind=kind, shared=shared, **how)
            for name, estimator in (models or default_models()).items():
                t = train_one(sample, steps, estimator, f"{ratio}/{kind}/{name}", [*numbers, *categories], label)
                scored = {n: t.score(df).cache() for n, df in sets.items()}
                for n, df in scored.items():
                    thresholds = evaluate.score_thresholds(df, "score")
                    if not t.tables:
                        t.thresholds = thresholds
                        t.bands = [(r.v, r.n) for r in band_counts(df, "score", SCORE_BANDS).orderBy("v").collect()]
                    t.tables[n] = evaluate.evaluation(df, score="score", label=col, positive=positive, negative=negative, thresholds=thresholds, null_label=null_label).orderBy("band").collect()
                if len(scored) > 1:
                    a, b = list(scored.values())[:2]
                    t.psi = psi(band_counts(a, "score", SCORE_BANDS), band_counts(b, "score", SCORE_BANDS))
                for df in scored.values():
                    df.unpersist()
                out[t.name] = t
        sample.unpersist()
    return out


@dataclass(frozen=True)
class Choice:
    """The outcome of training: the best model or None, all verdicts, and warnings."""

    best: Trained | None
    verdicts: dict
    warnings: tuple[str, ...]


def best_of(trained: Mapping[str, Trained], on: str) -> Choice:
    """The best model by its table on the data set `on`; none if all are weak."""
    name, verdicts = evaluate.choose({n: t.tables[on] for n, t in trained.items()})
    best = trained.get(name) if name else None
    warnings = (f"{name}: stability {best.psi:.3f}",) if best is not None and best.psi is not None and best.psi > PSI_LIMIT else ()
    return Choice(best, verdicts, warnings)


def retrain(choice: Choice, again: Callable[[Sequence[str]], Trained], columns: Sequence[str], on: str, *, limit: int = 0, moved: float = 0.1) -> Choice:
    """The choice with its best model trained again (`again`, from the columns given) without the columns that its steps drop, if those are more than `limit`.

    Warns where the indicator on the data set `on` moves by more than the share `moved`.
    """
    best = choice.best
    dropped = {c for s in best.steps for c in s.dropped} & set(columns) if best is not None else set()
    if best is None or len(dropped) <= limit:
        return choice
    new = again([c for c in columns if c not in dropped])
    before, after = (evaluate.indicator(t.tables[on]) for t in (best, new))
    warnings = choice.warnings
    if abs(after - before) > moved * before:
        warnings = (*warnings, f"{best.name}: trained again without {len(dropped)} columns, the indicator moved from {before:.2f} to {after:.2f}")
    return Choice(new, choice.verdicts, warnings)
