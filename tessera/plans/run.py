"""A whole linkage run over tables of records, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import blocking, candidates, decision, labels, metrics, models, submission
from tessera.operators import records as rec
from tessera.operators.features import pair_features, proxy
from tessera.sources import io


def blocks(records: DataFrame, stripped: DataFrame) -> list[DataFrame]:
    return [blocking.exact(records, "address_norm", "address"), blocking.exact(records, "address_compact", "address_compact"), blocking.exact(records, "name_norm", "name"), blocking.rare_topk(records, "name_tokens", "rare_name", drop_numbers=True), blocking.rare_topk(records, "address_tokens", "rare_address"), blocking.number_prefix(stripped), blocking.core_name(stripped), blocking.domain_name(stripped), blocking.ascii_exact(records), blocking.number_anchor(records), blocking.rare_strict(records)]


def run(spark: SparkSession, raw: DataFrame, out: str, truth: DataFrame | None = None, learn: bool = False, threshold: float = 0.585, force: bool = False) -> dict:
    """Normalise, block, prune, featurise, score, decide and write; a stage found at `out` is used again.

    With truth the threshold is searched on a held-out fifth of the source-1 records; with learn a
    boosted model, fitted on the other records, takes the place of the rule score.
    """
    stage = lambda name, build: io.cached_stage(spark, f"{out}/{name}", build, force=force)
    records = stage("records", lambda: rec.with_stripped(rec.normalise(raw)))
    entities = records.where("source = 'S1'").select(F.col("entity_id").alias("source1_entity_id"))
    pairs = stage("candidates", lambda: candidates.prune_medium(candidates.union_provenance(blocks(records, records)), records))
    feats = stage("features", lambda: pair_features(pairs, records))
    figures: dict = {"threshold": threshold}
    model = None
    if learn and truth is not None:
        model = models.train(labels.split(labels.label_pairs(feats, truth))[0])
    scored = stage("scored", lambda: models.predict(model, feats).select(*io.PAIR, "score") if model else feats.select(*io.PAIR, F.round(proxy(feats.columns), 6).alias("score")))
    if truth is not None:
        held = labels.split(entities)[1]
        best, _ = metrics.search(labels.split(scored)[1], labels.split(truth)[1], held)
        figures["threshold"] = threshold = best if best is not None else threshold
        figures |= metrics.macro(labels.split(decision.threshold(scored, threshold))[1], labels.split(truth)[1], held).first().asDict()
    chosen = decision.threshold(scored, threshold)
    matches, listed = submission.result_lists(chosen, entities), submission.result_lists(pairs, entities, "candidate_entity_ids")
    io.write_tsv(matches, f"{out}/matching_results.tsv")
    io.write_tsv(listed, f"{out}/candidate_pairs.tsv")
    faults = submission.validate(matches, listed, entities, records.where("source <> 'S1'")).where("failures > 0").collect()
    figures["faults"] = {r["check"]: r["failures"] for r in faults}
    return figures
