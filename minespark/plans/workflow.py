"""The monthly jobs: train and test a model, score a population, and the SQL or plans that they would run."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minespark.functions.formula import closure, parse
from minespark.functions.periods import align_months
from minespark.functions.predicates import referenced_columns, without_columns
from minespark.operators import model as models
from minespark.operators.evaluate import evaluation
from minespark.operators.panel import base_counts, base_table, check_base, day_ready
from minespark.operators.sampling import hash_key, usable_ratios
from minespark.operators.prep import Fitted, find_step
from minespark.operators.score import ranked, rare_values, top_reasons, with_band_quality
from minespark.operators.stats import PSI_LIMIT, band_counts, drop_correlated, only_value, psi
from minespark.runtime import written
from minespark.plans.explore import FeaturePlan, create, explore, fitted_floors, prepared
from minespark.spec import ModelSpec

log = logging.getLogger("minespark")


@dataclass(frozen=True)
class TrainResult:
    """What training leaves: the spec, the feature plan, the choice (whose best is None if no model is good), and how the panel is prepared."""

    spec: ModelSpec
    plan: FeaturePlan
    choice: models.Choice
    numbers: tuple[str, ...] = ()
    categories: dict = field(default_factory=dict)
    formulas: dict = field(default_factory=dict)
    scores: tuple[str, ...] = ()

    def save(self, path: str) -> None:
        """The best model and all else as JSON in a folder that all executors share."""
        if self.choice.best is None:
            raise ValueError(f"{self.spec.name}: no model was chosen")
        self.choice.best.save(f"{path}/best")
        kept = {"spec": asdict(self.spec), "plan": self.plan.to_json(), "verdicts": self.choice.verdicts, "warnings": self.choice.warnings}
        kept |= {x: getattr(self, x) for x in ("numbers", "categories", "formulas", "scores")}
        SparkSession.active().createDataFrame([(json.dumps(kept, ensure_ascii=False),)], "result string").coalesce(1).write.mode("overwrite").text(f"{path}/result")

    @staticmethod
    def load(path: str) -> TrainResult:
        kept = json.loads(SparkSession.active().read.text(f"{path}/result").first()[0])
        choice = models.Choice(models.Trained.load(f"{path}/best"), kept["verdicts"], tuple(kept["warnings"]))
        spec = ModelSpec(**{k: _tuples(v) for k, v in kept["spec"].items()})
        return TrainResult(spec, FeaturePlan.from_json(kept["plan"]), choice, tuple(kept["numbers"]), kept["categories"], kept["formulas"], tuple(kept["scores"]))


def _tuples(x):
    return tuple(map(_tuples, x)) if isinstance(x, list) else x


def _wide(rows: DataFrame, spec: ModelSpec, plan: FeaturePlan | None, at: str, label: bool, *, numbers: Sequence[str], categories: dict, formulas: Mapping[str, str], scores: Sequence[str], **how) -> tuple[DataFrame, FeaturePlan]:
    """(wide table, plan): the prepared panel's features. Without a plan they are explored; what the plan learned, divisor floors too, is used as it is."""
    e, m = spec.col_id, spec.col_month
    parsed = {n: parse(n, f) for n, f in formulas.items()}
    floors = plan.floors if plan else fitted_floors(rows, parsed, period=m, at=at)
    ready = prepared(rows, entity=e, period=m, at=at, n=spec.n_recent, numbers=numbers, categories=list(categories), scores=scores, label=spec.label if label else None, formulas=parsed, floors=floors)
    ready = written(ready, "panel")
    if plan is None:
        plan = explore(ready, entity=e, period=m, at=at, label=spec.label, positive=spec.positive, negative=spec.negative, numbers=numbers, categories=categories, iv_limit=spec.iv_limit, r_limit=spec.r_limit, unique_limit=spec.unique_limit, valuecount_limit=spec.valuecount_limit, **how)
        plan = replace(plan, floors=floors)
    return written(create(ready, plan, entity=e, period=m, at=at, keep=[spec.label] if label else []), "wide"), plan


def aligned(base: DataFrame, spec: ModelSpec, at: str) -> DataFrame:
    """The base table as a panel: with cumulated months the periods of earlier base months are moved to the newest, `at`, and the ids marked by base month."""
    if not spec.cumulated_months:
        return base.drop("user_acct_month", "data_use")
    moved = align_months(base, base="user_acct_month", period=spec.col_month, entity=spec.col_id, newest=at)
    kind = dict(base.dtypes)[spec.col_month]
    return moved.withColumns({spec.col_month: F.col("a_period").cast(kind), spec.col_id: F.col("a_entity")}).drop("a_period", "a_entity", "user_acct_month", "data_use")


def _pruned(panel: DataFrame, spec: ModelSpec, *, numbers: Sequence[str], categories: Mapping, formulas: Mapping[str, str], scores: Sequence[str]) -> DataFrame:
    """The panel's columns that the job reads: those of the inputs or of what they are derived from, id, period, label, and what the condition mentions."""
    parsed = {n: parse(n, f) for n, f in formulas.items()}
    need = {c.lower() for c in (*closure([*numbers, *categories, *scores, *formulas], parsed), spec.col_id, spec.col_month, spec.label, *referenced_columns(spec.condition))}
    return panel.select(*(F.col(f"`{c}`") for c in panel.columns if c.lower() in need))


def train_and_test(panel: DataFrame, spec: ModelSpec, *, numbers: Sequence[str], categories: dict, algorithms: dict | None = None, kinds: Sequence[str] = ("woe",), formulas: Mapping[str, str] | None = None, scores: Sequence[str] = (), retrain_limit: int | None = None, **how) -> TrainResult:
    """Base table, exploration (`how` goes to explore()), wide tables of training, validation and test month, the model cycle, and the choice.

    `formulas` derive fields from the panel's (numbers and categories may name them), null `scores` count as 0. The choice is made on the out-of-time month if there is one, else
    on the validation rows; if the best model drops more than retrain_limit columns, it is trained again without them.
    """
    use = {"numbers": tuple(numbers), "categories": dict(categories), "formulas": dict(formulas or {}), "scores": tuple(scores)}
    panel = _pruned(panel, spec, **use)
    base = written(base_table(panel, spec, "train"), "base")
    for w in check_base(base_counts(base, spec), spec.n_recent):
        log.warning("%s: %s", spec.name, w)
    train, plan = _wide(aligned(base.where("data_use = 'data_train'"), spec, spec.month_train), spec, None, spec.month_train, True, **use, **how)
    timein, _ = _wide(base.where("data_use = 'data_timein'").drop("user_acct_month", "data_use"), spec, plan, spec.month_train, True, **use)
    sets = {"timein": timein}
    if spec.month_test:
        test, _ = _wide(base_table(panel, spec, "test").drop("user_acct_month", "data_use"), spec, plan, spec.month_test, True, **use)
        sets["timeout"] = test
    n_pos, n_neg = train.agg(F.count_if(F.col(spec.label).cast("string") == spec.positive), F.count_if(F.col(spec.label).cast("string") == spec.negative)).first()
    inputs = [c for c in train.columns if c not in (spec.col_id, spec.label)]
    cats = [c for c in inputs if c in categories]
    ratios = usable_ratios(spec.ratios, n_pos, n_neg)
    algorithms = algorithms or models.default_models()
    limits = {x: getattr(spec, x) for x in ("freq_limit", "unique_limit", "valuecount_limit", "iv_limit", "r_limit", "positive_limit", "stratified", "null_label")}

    def cycle(columns: Sequence[str], **part) -> dict[str, models.Trained]:
        every = {"ratios": ratios, "kinds": kinds, "models": algorithms} | part
        return models.cycle(train, sets, numbers=[c for c in columns if c not in cats], categories=[c for c in columns if c in cats], label=(spec.label, spec.positive, spec.negative), key=hash_key(F.col(spec.col_id)), **every, **limits)

    on = "timeout" if "timeout" in sets else "timein"
    choice = models.best_of(cycle(inputs), on)
    if retrain_limit is not None and choice.best is not None:
        ratio, kind, name = choice.best.name.split("/", 2)
        again = lambda columns: next(iter(cycle(columns, ratios=[r for r in ratios if str(r) == ratio][:1], kinds=[kind], models={name: algorithms[name]}).values()))
        choice = models.retrain(choice, again, inputs, on, limit=retrain_limit)
    for w in choice.warnings:
        log.warning(w)
    return TrainResult(spec, plan, choice, **use)


def reasons(rows: DataFrame, steps: Sequence[Fitted], *, n: int, threshold: float = 0.0, at_most: float = 50, r_limit: float = 0.8, comments: Mapping[str, str] | None = None, not_causes: Sequence[str] = ()) -> DataFrame | None:
    """rows, coded by the steps before WOE, with their top reasons; None without a WOE step.

    Causes are the columns of the WOE step but `not_causes`, and of each pair whose WOE codes correlate by r_limit or more in training
    only the one of greater IV. Values above the threshold that at most `at_most` rows hold are no reason. A column without comment has its name.
    """
    step = find_step(steps, "woe")
    if step is None:
        return None
    for s in steps:
        if s.kind != "woe":
            rows = s.apply(rows)
    causes = {c: r for c, r in step.rules.items() if c not in not_causes}
    if any("r" not in r for r in causes.values()):
        log.warning("the model keeps no correlations; correlated causes stay")
    pairs = [(a, b, x) for a, r in causes.items() for b, x in r.get("r", {}).items() if b in causes]
    gone = drop_correlated(pairs, {c: r.get("iv", 0.0) for c, r in causes.items()}, r_limit)
    woe = {c: r["woe"] for c, r in causes.items() if c not in gone}
    rare = rare_values(rows, woe, threshold=threshold, at_most=at_most)
    return top_reasons(rows, woe, n=n, threshold=threshold, comments={c: (comments or {}).get(c, c) for c in woe}, rare=rare)


def predict(panel: DataFrame, result: TrainResult, *, numbers: Sequence[str] | None = None, categories: dict | None = None, n_reasons: int = 3, **how) -> DataFrame:
    """Scores of the predict month: score, band with its training precision and lift, stability, reasons (`how` goes to reasons()), rank and level.

    Numbers and categories are those of training unless given. score_psi is the stability of ten score bands against the first data set of training, null where that kept none;
    beyond PSI_LIMIT it warns.
    """
    spec, best = result.spec, result.choice.best
    if best is None:
        raise ValueError(f"{spec.name}: no model was chosen")
    used = {*result.plan.raw, *(c for d in (*result.plan.current, *result.plan.recent) for c in d.inputs)}  # only what reaches the model
    parsed = {n: parse(n, f) for n, f in result.formulas.items()}
    derived = [c for c in closure(sorted(used), parsed) if c in parsed]
    read = {*closure(sorted(used), parsed)}
    use = {
        "numbers": [c for c in (result.numbers if numbers is None else numbers) if c in used], "categories": {c: v for c, v in (result.categories if categories is None else categories).items() if c in used},
        "formulas": {c: result.formulas[c] for c in derived}, "scores": tuple(c for c in result.scores if c in read),
    }
    rows = base_table(_pruned(panel, spec, **use), spec, "predict").drop("user_acct_month", "data_use")
    only_value(rows.where(F.col(spec.col_month) == spec.month_predict), spec.col_month)
    wide, _ = _wide(rows, spec, result.plan, spec.month_predict, False, **use)
    scored = written(best.score(wide), "scored")
    spark = panel.sparkSession
    quality = [(r.band, r.precision, r.lift) for r in next(iter(best.tables.values()), [])]
    out = with_band_quality(scored, best.thresholds, spark.createDataFrame(quality, "band int, precision double, lift double"))
    moved = None
    if best.bands:
        try:
            moved = psi(spark.createDataFrame(best.bands, "v int, n long"), band_counts(scored, "score", models.SCORE_BANDS))
        except ValueError as e:
            log.warning("%s: %s", spec.name, e)
        if moved is not None and moved > PSI_LIMIT:
            log.warning("%s: stability of the scores %.3f", spec.name, moved)
    found = reasons(wide, best.steps, n=n_reasons, **how)
    if found is not None:
        out = out.join(found.select(spec.col_id, *(c for c in found.columns if "_top" in c)), spec.col_id)
    out = ranked(out, ties=[*spec.sort_ties, (spec.col_id, True)])
    return out.withColumns({"model_name": F.lit(spec.name), "month_train": F.lit(spec.month_train), "month_test": F.lit(spec.month_test), spec.col_month: F.lit(spec.month_predict), "score_psi": F.lit(moved).cast("double")})


def day_data(spec: ModelSpec, daily: DataFrame | None, *, day_column: str, day: int, inputs: Sequence[str], prefix: str = "dayvalue_") -> ModelSpec:
    """The spec as it can run today: an input that needs a day not yet loaded is an error, conjuncts that do are dropped."""
    kept, dropped = without_columns(spec.condition, prefix)
    needs = [c for c in inputs if c.startswith(prefix)]
    if not needs and not dropped:
        return spec
    if daily is not None and day_ready(daily, at=spec.month_predict, day_column=day_column, day=day):
        return spec
    if needs:
        raise ValueError(f"{spec.name}: the day for {needs} is not loaded")
    log.warning("%s: dropped %s, the day is not loaded", spec.name, dropped)
    return spec.with_condition(kept)


def performance(scored: DataFrame, spec: ModelSpec, thresholds: Sequence[float]) -> DataFrame:
    return evaluation(scored, score="score", label=spec.label, positive=spec.positive, negative=spec.negative, thresholds=thresholds, null_label=spec.null_label)
