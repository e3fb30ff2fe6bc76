"""Command lines: python -m tessera COMMAND --out FOLDER ...

The folder holds what each command writes and the next ones read: records, blocks/NAME, candidates, features, model,
scored, matching_results.tsv and candidate_pairs.tsv.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import blocking, candidates, decision, labels, metrics, models, submission
from tessera.operators import records as rec
from tessera.operators.features import pair_features, proxy
from tessera.plans import run as whole
from tessera.plans.session import session
from tessera.sources import io

BLOCKS = {
    "address": lambda r: blocking.exact(r, "address_norm", "address"), "address_compact": lambda r: blocking.exact(r, "address_compact", "address_compact"), "name": lambda r: blocking.exact(r, "name_norm", "name"),
    "name_compact": lambda r: blocking.exact(r, "name_compact", "name_compact"), "rare_name": lambda r: blocking.rare_topk(r, "name_tokens", "rare_name", drop_numbers=True), "rare_address": lambda r: blocking.rare_topk(r, "address_tokens", "rare_address"),
    "num_pfx": blocking.number_prefix, "core_name": blocking.core_name, "domain_name": blocking.domain_name, "indic_translit": blocking.transliterated, "ascii_exact": blocking.ascii_exact, "numeric_anchor": blocking.number_anchor, "rare_name_strict": blocking.rare_strict,
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tessera")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, **options) -> None:
        p = sub.add_parser(name)
        p.add_argument("--out", required=True)
        p.add_argument("--cores", default="*")
        p.add_argument("--memory")
        for key, kw in options.items():
            p.add_argument(f"--{key.replace('_', '-')}", **kw)

    sources = {f"s{i}": {"required": True} for i in (1, 2, 3)}
    truth = {"required": True}
    command("normalise", **sources)
    command("tokens", token_type={"choices": ["name", "address"], "default": "name"})
    command("block", block={"choices": [*BLOCKS, "all"], "default": "all"})
    command("union", set={"choices": list(candidates.SETS), "default": "all"})
    command("pool", methods={"nargs": "+", "choices": list(BLOCKS), "default": ["rare_name_strict", "core_name"]})
    command("features")
    command("train", truth=truth, kind={"choices": ["gbt", "forest", "linear"], "default": "gbt"}, rounds={"type": int, "default": 20}, depth={"type": int, "default": 5})
    command("score", rule={"action": "store_true"})
    command("grid", truth=truth, thresholds={"type": float, "nargs": "+", "default": metrics.THRESHOLDS}, refine={"action": "store_true"})
    command("submit", threshold={"type": float, "default": 0.585})
    command("validate", check_ids={"action": "store_true"})
    command("run", **sources, truth={}, learn={"action": "store_true"}, threshold={"type": float, "default": 0.585}, force={"action": "store_true"})
    return top


def _raw(spark: SparkSession, args) -> DataFrame:
    return io.read_source(spark, args.s1, "S1").unionByName(io.read_source(spark, args.s2, "S2")).unionByName(io.read_source(spark, args.s3, "S3"))


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.getActiveSession() or session(args.cores, args.memory)
    out = args.out
    at = lambda name: spark.read.parquet(f"{out}/{name}")
    truth = lambda: io.ground_truth(io.read_tsv(spark, args.truth, io.TRUTH_SCHEMA))
    entities = lambda: at("records").where("source = 'S1'").select(F.col("entity_id").alias("source1_entity_id"))
    if args.command == "normalise":
        io.write_parquet(rec.with_stripped(rec.normalise(_raw(spark, args))), f"{out}/records")
    elif args.command == "tokens":
        io.write_parquet(rec.token_stats(at("records"), f"{args.token_type}_tokens"), f"{out}/tokens_{args.token_type}")
    elif args.command == "block":
        for name in BLOCKS if args.block == "all" else [args.block]:
            io.write_parquet(BLOCKS[name](at("records")), f"{out}/blocks/{name}")
    elif args.command == "union":
        made = candidates.union_set({b: at(f"blocks/{b}") for b in candidates.SETS[args.set]}, args.set)
        io.write_parquet(candidates.prune_medium(made, at("records")), f"{out}/candidates")
    elif args.command == "pool":
        io.write_parquet(candidates.pool(at("candidates"), {m: at(f"blocks/{m}") for m in args.methods}, args.methods), f"{out}/candidates")
    elif args.command == "features":
        io.write_parquet(pair_features(at("candidates"), at("records")), f"{out}/features")
    elif args.command == "train":
        model = models.train(labels.split(labels.label_pairs(at("features"), truth()))[0], kind=args.kind, rounds=args.rounds, depth=args.depth)
        models.save(model, f"{out}/model")
        if args.kind != "linear":
            models.write_importance(model, f"{out}/importance.csv")
    elif args.command == "score":
        f = at("features")
        scored = f.select(*io.PAIR, F.round(proxy(f.columns), 6).alias("score")) if args.rule else models.predict(models.load(f"{out}/model"), f).select(*io.PAIR, "score")
        io.write_parquet(scored, f"{out}/scored")
    elif args.command == "grid":
        held = [labels.split(df)[1] for df in (at("scored"), truth(), entities())]
        (metrics.refined(*held, args.thresholds) if args.refine else metrics.threshold_grid(*held, args.thresholds)).orderBy("threshold").show(200, False)
    elif args.command == "submit":
        io.write_tsv_file(submission.result_lists(decision.threshold(at("scored"), args.threshold), entities()), f"{out}/matching_results.tsv")
        io.write_tsv_file(submission.result_lists(at("candidates"), entities(), "candidate_entity_ids"), f"{out}/candidate_pairs.tsv")
    elif args.command == "validate":
        faults, known = 0, at("records").where("source <> 'S1'") if args.check_ids else None
        for name, column in (("matching_results", "matched_entity_ids"), ("candidate_pairs", "candidate_entity_ids")):
            for r in submission.check_file(spark, f"{out}/{name}.tsv", ("source1_entity_id", column), entities(), known).where("failures > 0").collect():
                print(f"{name}: {r['check']}: {r['failures']}")
                faults += r["check"] != "empty lists"
        return int(faults > 0)
    else:
        print(whole.run(spark, _raw(spark, args), out, truth() if args.truth else None, args.learn, args.threshold, args.force))
    return 0


if __name__ == "__main__":
    sys.exit(main())
