"""Every operator as a query on the sample tables, with the SQL that gives the same rows."""

from __future__ import annotations

import math
from functools import cached_property
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import blocking, candidates, crowd, decision, features, labels, metrics, models, pairs, quality, submission
from tessera.operators import records as rec
from tessera.sources import io

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _lists(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


_P, _ID = "source1_entity_id, matched_entity_id, matched_source", "'S' || (1 + doc_id % 3) || '-' || lpad(doc_id::VARCHAR, greatest(6, length(doc_id::VARCHAR))::INTEGER, '0')"
_TRIM = "lower(trim(coalesce({0}, '')))"


def _norm(c: str) -> str:
    return rf"regexp_replace(regexp_replace({_TRIM.format(c)}, '[[:punct:]]', ' ', 'g'), '\s+', ' ', 'g')"


def _compact(c: str) -> str:
    return f"regexp_replace({_TRIM.format(c)}, '[[:space:][:punct:]]', '', 'g')"


def _join(cte: str, on: str, name: str, one: str = "", two: str = "") -> str:
    return f"SELECT DISTINCT a.entity_id AS source1_entity_id, b.entity_id AS matched_entity_id, b.source AS matched_source, '{name}' AS block_name FROM {cte} a JOIN {cte} b ON {on} WHERE a.source = 'S1' AND b.source <> 'S1'{one}{two}"


def _exact(key: str, name: str) -> str:
    return _join("n", f"a.country_norm = b.country_norm AND a.{key} = b.{key}", name, f" AND a.{key} <> '' AND a.country_norm <> ''")


def _tok(col: str, least: int = 1, more: str = "") -> str:
    return f"SELECT DISTINCT source, country_norm, entity_id, lower(trim(u.t)) AS token FROM n, unnest({col}) AS u(t) WHERE trim(country_norm) <> '' AND trim(u.t) <> '' AND length(trim(u.t)) >= {least}{more}"


def _rare(rows: str, cap: int) -> str:
    return f"SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY source, country_norm, token) AS token_freq FROM {rows}) WHERE token_freq <= {cap}"


def _topk(rows: str, index: str, name: str) -> str:
    return f"""SELECT DISTINCT c.entity_id AS source1_entity_id, i.entity_id AS matched_entity_id, i.source AS matched_source, '{name}' AS block_name FROM (
      SELECT a.entity_id, i.source, i.country_norm, i.token, row_number() OVER (PARTITION BY a.entity_id, i.source ORDER BY i.token_freq, length(i.token) DESC, i.token) AS k
      FROM {rows} a JOIN (SELECT DISTINCT source, country_norm, token, token_freq FROM {index}) i ON a.country_norm = i.country_norm AND a.token = i.token WHERE a.source = 'S1') c
    JOIN {index} i ON i.source = c.source AND i.country_norm = c.country_norm AND i.token = c.token WHERE c.k <= 2"""


_STOP = f" AND lower(trim(u.t)) NOT IN ({_lists(text.STOP_TOKENS)})"
_LATIN = "strip_accents({0})"
for _a, _b in text.LATIN_LETTERS.items():
    _LATIN = f"replace({_LATIN}, '{_a}', '{_b}')"
_U = lambda x, y: f"len(list_distinct({x})), len(list_distinct({y}))"


def _overlap(x: str, y: str) -> str:
    return f"(CASE WHEN least({_U(x, y)}) = 0 THEN 0.0 ELSE len(list_intersect({x}, {y}))::DOUBLE / least({_U(x, y)}) END)::FLOAT"


def _jaccard(x: str, y: str) -> str:
    d = f"(len(list_distinct({x})) + len(list_distinct({y})) - len(list_intersect({x}, {y})))"
    return f"(CASE WHEN {d} = 0 THEN 0.0 ELSE len(list_intersect({x}, {y}))::DOUBLE / {d} END)::FLOAT"


def _side(f: str) -> str:
    a, b, ta, tb, da, db = f"a.{f}_norm", f"b.{f}_norm", f"a.{f}_tokens", f"b.{f}_tokens", f"a.{f}_digits", f"b.{f}_digits"
    same = lambda x, y: f"CASE WHEN {x} <> '' AND {x} = {y} THEN 1 ELSE 0 END::TINYINT"
    return f"""{same(a, b)} AS {f}_exact, {same(f"a.{f}_compact", f"b.{f}_compact")} AS {f}_compact_exact, {same(f"strip_accents({a})", f"strip_accents({b})")} AS {f}_ascii_exact,
      (CASE WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE jaro_winkler_similarity({a}, {b}) END)::FLOAT AS {f}_char_ratio, {_overlap(ta, tb)} AS {f}_token_overlap, {_jaccard(ta, tb)} AS {f}_token_jaccard,
      abs(length({a}) - length({b}))::SMALLINT AS {f}_length_diff, abs(len({ta}) - len({tb}))::TINYINT AS {f}_token_count_diff, {_overlap(da, db)} AS {f}_numeric_overlap,
      CASE WHEN len({da}) > 0 AND len({db}) > 0 AND list_sort(list_distinct({da})) = list_sort(list_distinct({db})) THEN 1 ELSE 0 END::TINYINT AS {f}_numeric_exact,
      (CASE WHEN greatest(length({a}), length({b})) = 0 THEN 0.0 ELSE least(length({a}), length({b}))::DOUBLE / greatest(length({a}), length({b})) END)::FLOAT AS {f}_length_ratio"""


def _union(parts: list[str], n: str = "bit_count(blocking_mask)::TINYINT") -> str:
    bits = candidates.BITS
    rows = " UNION ALL ".join(f"SELECT * FROM {p}" for p in parts)
    case = " ".join(f"WHEN '{k}' THEN {v}" for k, v in bits.items())
    names = ", ".join(f"CASE WHEN blocking_mask & {v} <> 0 THEN '{k}' END" for k, v in bits.items())
    return f"SELECT {_P}, blocking_mask, {n} AS num_blocking_methods, concat_ws('|', {names}) AS blocking_methods FROM (SELECT {_P}, bit_or((CASE block_name {case} END)::INTEGER) AS blocking_mask, count(*) AS _rows FROM ({rows}) GROUP BY ALL)"


_BASE = ["b_address", "b_address_compact", "b_name", "b_rare_name", "b_rare_address"]
_PROXY = " + ".join(f"{c}::DOUBLE * {w}" for c, w in features.PROXY.items())
CTES = {
    "rec": f"SELECT {_ID} AS entity_id, 'S' || (1 + doc_id % 3) AS source, substr(text, 1, 60) AS business_name, substr(text, 61, 120) AS business_address, lang AS country FROM documents",
    "n0": f"SELECT *, {_norm('business_name')} AS name_norm, {_compact('business_name')} AS name_compact, {_norm('business_address')} AS address_norm, {_compact('business_address')} AS address_compact, regexp_replace({_TRIM.format('country')}, '[^a-z0-9]+', '', 'g') AS country_norm FROM rec",
    "n": "SELECT *, " + ", ".join(f"list_filter(string_split({f}_norm, ' '), lambda x: trim(x) <> '') AS {f}_tokens, list_filter(string_split({f}_norm, ' '), lambda x: trim(x) <> '' AND regexp_matches(x, '[0-9]')) AS {f}_numeric_tokens, regexp_extract_all({f}_norm, '[0-9]+') AS {f}_digits" for f in ("name", "address")) + " FROM n0",
    "truth": f"SELECT a.id AS source1_entity_id, b.id AS matched_entity_id, b.s AS matched_source FROM (SELECT {_ID} AS id, lang, text FROM documents WHERE doc_id % 3 = 0) a JOIN (SELECT {_ID} AS id, 'S' || (1 + doc_id % 3) AS s, lang, text FROM documents WHERE doc_id % 3 <> 0) b ON a.lang = b.lang AND a.text = b.text",
    "ent": "SELECT DISTINCT entity_id AS source1_entity_id FROM rec WHERE source = 'S1'",
    "tn": _tok("name_tokens"), "ta": _tok("address_tokens"), "tnx": _tok("name_tokens", 1, " AND NOT regexp_matches(lower(trim(u.t)), '^[0-9]+$')"),
    "tns": _tok("name_tokens", 5, _STOP), "tas": _tok("address_tokens", 4, _STOP),
    "rn": "SELECT * FROM (" + _rare("(SELECT * FROM tnx WHERE source <> 'S1')", 50) + ")", "ra": "SELECT * FROM (" + _rare("(SELECT * FROM ta WHERE source <> 'S1')", 50) + ")",
    "rns": "SELECT * FROM (" + _rare("(SELECT * FROM tns WHERE source <> 'S1')", 20) + ")", "ras": "SELECT * FROM (" + _rare("(SELECT * FROM tas WHERE source <> 'S1')", 50) + ")",
    "b_name": _exact("name_norm", "name"), "b_address": _exact("address_norm", "address"), "b_address_compact": _exact("address_compact", "address_compact"), "b_name_compact": _exact("name_compact", "name_compact"),
    "b_rare_name": _topk("tn", "rn", "rare_name"), "b_rare_address": _topk("ta", "ra", "rare_address"),
    "k": rf"SELECT source, entity_id, country_norm, lower(regexp_extract(strip_accents(name_norm), '^([a-z0-9]{{3}})', 1)) AS pfx, address_numeric_tokens[1] AS num, trim(regexp_replace(strip_accents(name_norm), '\b({'|'.join(text.LEGAL_SUFFIXES)})\b.*$', '', 'g')) AS core, regexp_replace(regexp_replace(strip_accents(name_compact), '^({'|'.join(text.DOMAIN_STARTS)})', ''), '({'|'.join(text.DOMAIN_ENDS)})$', '') AS dom, {_LATIN.format('name_norm')} AS an, {_LATIN.format('name_compact')} AS ac, name_norm, name_compact, strip_accents(name_norm) AS stripped, {_LATIN.format('name_norm')} AS tn, {_LATIN.format('name_compact')} AS tc FROM n",
    "b_num_pfx": _join("k", "a.country_norm = b.country_norm AND a.pfx = b.pfx AND a.num = b.num", "num_pfx", " AND a.pfx <> '' AND a.num <> '' AND a.country_norm <> ''"),
    "b_core_name": _join("k", "a.country_norm = b.country_norm AND a.core = b.core", "core_name", " AND length(a.core) >= 4 AND a.country_norm <> ''"),
    "b_domain_name": _join("k", "a.country_norm = b.country_norm AND a.dom = b.dom", "domain_name", " AND length(a.dom) >= 5 AND a.country_norm <> ''"),
    "b_ascii": _join("k", "a.country_norm = b.country_norm AND a.an = b.an", "ascii_exact", " AND a.an <> '' AND a.country_norm <> ''") + " UNION " + _join("k", "a.country_norm = b.country_norm AND a.ac = b.ac", "ascii_exact", " AND a.ac <> '' AND a.country_norm <> ''"),
    "b_translit": _join("k", "a.country_norm = b.country_norm AND a.name_norm = trim(b.tn)", "indic_translit", " AND b.stripped <> b.name_norm AND length(a.name_norm) >= 3 AND a.country_norm <> ''") + " UNION " + _join("k", "a.country_norm = b.country_norm AND a.name_compact = trim(b.tc)", "indic_translit", " AND b.stripped <> b.name_norm AND length(a.name_compact) >= 3 AND a.country_norm <> ''"),
    "b_strict": "SELECT DISTINCT a.entity_id AS source1_entity_id, b.entity_id AS matched_entity_id, b.source AS matched_source, 'rare_name_strict' AS block_name FROM tns a JOIN rns b ON a.country_norm = b.country_norm AND a.token = b.token WHERE a.source = 'S1'",
    "b_overlap": "SELECT p.*, 'rare_address' AS block_name FROM (SELECT a.entity_id AS source1_entity_id, b.entity_id AS matched_entity_id, b.source AS matched_source, count(*)::INTEGER AS address_overlap FROM tas a JOIN ras b ON a.country_norm = b.country_norm AND a.token = b.token WHERE a.source = 'S1' GROUP BY ALL) p JOIN n x ON x.entity_id = source1_entity_id JOIN n y ON y.entity_id = matched_entity_id WHERE address_overlap >= 3 OR x.name_norm = y.name_norm OR x.name_compact = y.name_compact",
    "uni": _union(_BASE),
    "expn": _union(["b_strict", "b_core_name"]),
    "pruned": f"SELECT u.* FROM uni u JOIN n a ON a.entity_id = source1_entity_id JOIN n b ON b.entity_id = matched_entity_id WHERE num_blocking_methods >= 2 OR (blocking_methods IN ('name', 'rare_address') AND (a.name_norm = b.name_norm OR a.name_compact = b.name_compact)) OR (blocking_methods = 'rare_address' AND len(list_intersect(a.address_tokens, b.address_tokens)) >= 3)",
    "feat": f"SELECT {_P}, blocking_mask::SMALLINT AS blocking_mask, num_blocking_methods, blocking_methods, {_side('name')}, {_side('address')}, CASE WHEN a.country <> '' AND a.country = b.country THEN 1 ELSE 0 END::TINYINT AS country_exact, CASE WHEN a.name_norm <> '' THEN 1 ELSE 0 END::TINYINT AS name_present, CASE WHEN a.address_norm <> '' THEN 1 ELSE 0 END::TINYINT AS address_present, "
    + ", ".join(f"CASE WHEN blocking_mask & {v} <> 0 THEN 1 ELSE 0 END::TINYINT AS block_{k}" for k, v in list(candidates.BITS.items())[:5])
    + ", CASE WHEN num_blocking_methods >= 2 THEN 1 ELSE 0 END::TINYINT AS block_hybrid FROM pruned JOIN n a ON a.entity_id = source1_entity_id JOIN n b ON b.entity_id = matched_entity_id",
    "lab": f"SELECT f.*, CASE WHEN t.source1_entity_id IS NULL THEN 0 ELSE 1 END::TINYINT AS label FROM feat f LEFT JOIN truth t USING ({_P})",
    "sc": f"SELECT {_P}, round({_PROXY}, 6) AS score, label FROM lab",
}


class Context:
    """The tables that queries share, each made when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf = spark, sf_dir

    @cached_property
    def n(self) -> DataFrame:
        return rec.normalise(io.sample_records(self.spark, self.sf))

    @cached_property
    def stripped(self) -> DataFrame:
        """Records with all views, written once: blocks, pruning and features read their columns from there."""
        return io.kept(rec.with_stripped(self.n))

    @cached_property
    def truth(self) -> DataFrame:
        return io.sample_truth(self.spark, self.sf)

    @cached_property
    def entities(self) -> DataFrame:
        r = io.sample_records(self.spark, self.sf)
        return r.where("source = 'S1'").select(F.col("entity_id").alias("source1_entity_id"))

    def parts(self) -> list[DataFrame]:
        n = self.stripped
        return [blocking.exact(n, "address_norm", "address"), blocking.exact(n, "address_compact", "address_compact"), blocking.exact(n, "name_norm", "name"), blocking.rare_topk(n, "name_tokens", "rare_name", drop_numbers=True), blocking.rare_topk(n, "address_tokens", "rare_address")]

    @cached_property
    def blocks(self) -> dict[str, DataFrame]:
        return dict(zip(("address", "address_compact", "name", "rare_name", "rare_address"), self.parts()))

    @cached_property
    def more_blocks(self) -> dict[str, DataFrame]:
        return {"rare_name_strict": blocking.rare_strict(self.stripped), "core_name": blocking.core_name(self.stripped)}

    @cached_property
    def union(self) -> DataFrame:
        return io.kept(candidates.union_provenance(self.parts()))

    @cached_property
    def pruned(self) -> DataFrame:
        return candidates.prune_medium(self.union, self.stripped)

    @cached_property
    def expansion(self) -> DataFrame:
        return candidates.union_provenance(list(self.more_blocks.values()))

    @cached_property
    def features(self) -> DataFrame:
        return features.pair_features(self.pruned, self.stripped)

    @cached_property
    def labelled(self) -> DataFrame:
        return labels.label_pairs(self.features, self.truth)

    @cached_property
    def scored(self) -> DataFrame:
        lab = self.labelled
        return lab.select(*io.PAIR, F.round(features.proxy(lab.columns), 6).alias("score"), "label")


    # Pairs of one name are scored in their cells (operators/crowd.py); all of them are pruned candidates, whatever other block has them.
    @cached_property
    def alone(self) -> bool:
        """Whether ids name one record each; where they do not, all pairs take the plain way."""
        return pairs.unique_ids(self.stripped)

    def unnamed_blocks(self) -> DataFrame:
        """The union of all blocks but the name's, without most pairs that share a name: no exact block makes them."""
        exact = [blocking.exact(self.stripped, key, name, apart="name_norm") for key, name in (("address_norm", "address"), ("address_compact", "address_compact"))]
        return candidates.union_provenance([*exact, *[self.blocks[name] for name in ("rare_name", "rare_address")]])

    @cached_property
    def unnamed(self) -> DataFrame:
        """Candidates that share no name, written once."""
        return io.kept(candidates.without_shared_name(self.unnamed_blocks(), self.stripped))

    @cached_property
    def others(self) -> DataFrame:
        """Scored and labelled candidates that share no name (all candidates where ids repeat), written once."""
        if self.alone:  # the union of all blocks, which would write the pairs of one name, is not made; only pairs that pruning keeps meet all columns
            union = self.__dict__.get("unnamed")
            few = candidates.prune_medium(self.unnamed_blocks() if union is None else union, self.stripped, named=False)
            rows = features.enriched(few, self.stripped, ["truth_key"])
            label = F.coalesce(F.col("a_truth_key") == F.col("b_truth_key"), F.lit(False)).cast("tinyint").alias("label")
            rows = features.proxy_parts(rows, *io.PAIR, label)
        else:
            rows = labels.label_pairs(features.pair_features(self.pruned, self.stripped).select(*io.PAIR, *features.PROXY), self.truth)
        return io.kept(rows.select(*io.PAIR, F.round(features.proxy(rows.columns), 6).alias("score"), "label", *[F.col(p).cast("double").alias(p) for p in features.PROXY]))

    def asked(self, ask: crowd.Ask, least=None) -> DataFrame:
        """Scored pairs (score, label, best) of which only those that ask can do without are missing."""
        rest = self.others.select(*io.PAIR, "score", "label", F.lit(True).alias("best"))
        return crowd.answers(self.stripped, ask, least).unionByName(rest) if self.alone else rest

    def counted(self, settings: list[tuple], chosen: DataFrame) -> DataFrame:
        """(setting, source1_entity_id, p, tp) of all candidates; chosen has those of others that pass, by setting."""
        rest = metrics.counts_by(chosen, "setting", self.truth)
        if not self.alone:
            return rest
        rows = crowd.answers(self.stripped, crowd.Count(settings)).unionByName(rest)
        return rows.groupBy("setting", "source1_entity_id").agg(F.sum("p").alias("p"), F.sum("tp").alias("tp"))

    def at_thresholds(self, thresholds: list[float]) -> DataFrame:
        """metrics.counts_by() of the rule score at every threshold."""
        steps = F.array(*[F.lit(float(t)) for t in thresholds])
        chosen = self.others.select(*io.PAIR, F.explode(F.filter(steps, lambda t: F.col("score") >= t)).alias("setting"))
        return self.counted([(float(t), float(t)) for t in thresholds], chosen)

    def threshold_grid(self, thresholds: list[float]) -> DataFrame:
        grid = metrics.grid_of_counts(self.at_thresholds(thresholds), "setting", [float(t) for t in thresholds], self.truth, self.entities)
        return grid.withColumnRenamed("setting", "threshold")

    def blend_grid(self, parts: list[str], thresholds: list[float], blends: dict) -> DataFrame:
        settings = [(float(i), float(t), tuple(x / float(sum(w)) for x in w)) for i, (w, t) in enumerate(product(blends.values(), thresholds))]
        per = self.counted(settings, metrics.blend_choices(self.others, parts, thresholds, blends))
        return metrics.named_blends(metrics.grid_of_counts(per, "setting", [s[0] for s in settings], self.truth, self.entities), thresholds, blends)

    def calibrated(self, thresholds: dict[str, list[float]], deltas: list[float], tops: list[int], other: float) -> DataFrame:
        """metrics.calibration_grid(); of the pairs of one name a record's best leave the cells, as no combination takes others."""
        least = decision.least_of({n: min(ts) for n, ts in thresholds.items()}, other)
        chosen = metrics.calibration_choices(self.asked(crowd.Best(max(tops)), least).drop("best"), self.stripped, thresholds, deltas, tops, other)
        per = chosen.groupBy("setting", "source1_entity_id").agg(F.count(F.lit(1)).alias("p"), F.sum("label").alias("tp"))
        settings = [float(i) for i in range(math.prod(map(len, [*thresholds.values(), deltas, tops])))]
        grid = metrics.grid_of_counts(per, "setting", settings, self.truth, self.entities, metrics.true_counts(self.stripped) if self.alone else None)
        return metrics.named_settings(grid, thresholds, deltas, tops)


def _q(name: str, fn, sql: str | None) -> None:
    QUERIES[name] = lambda spark, sf_dir: fn(Context(spark, sf_dir))
    if sql:
        ORACLES[name] = "WITH " + ", ".join(f"{k} AS ({v})" for k, v in CTES.items()) + " " + sql


def _doubles(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(F.col(c).cast("double"), 6).alias(c) if t == "float" else F.col(c) for c, t in df.dtypes])


_ALL = "SELECT * FROM "
_RATES = "CASE WHEN true_pairs = 0 THEN 0.0 ELSE round(100.0::DOUBLE * covered / true_pairs, 6) END AS recall, CASE WHEN candidate_pairs = 0 THEN 0.0 ELSE round(100.0::DOUBLE * covered / candidate_pairs, 6) END AS purity"
_MARKED = f"(SELECT {_P}, max(c) AS c, max(t) AS t FROM (SELECT DISTINCT {_P}, 1 AS c, 0 AS t FROM {{0}} UNION ALL SELECT DISTINCT {_P}, 0, 1 FROM truth) GROUP BY ALL)"
_SUMS = "coalesce(sum(c), 0)::BIGINT AS candidate_pairs, coalesce(sum(t), 0)::BIGINT AS true_pairs, coalesce(sum(c * t), 0)::BIGINT AS covered"


def _lists_of(cols: str) -> str:
    return ", ".join(f"array_to_string({c}, ' ') AS {c}" for c in cols.split())


_TOKS = "name_tokens name_numeric_tokens address_tokens address_numeric_tokens"
_VIEWS = "entity_id, source, name_norm, name_compact, address_norm, address_compact, country_norm"
_q("normalize_records", lambda c: c.n.select(*_VIEWS.split(", "), *[F.array_join(t, " ").alias(t) for t in _TOKS.split()]), f"SELECT {_VIEWS}, {_lists_of(_TOKS)} FROM n")
_q("core_name", lambda c: c.stripped.select("entity_id", text.core_name(F.col("name_stripped")).alias("core_name")), "SELECT entity_id, core AS core_name FROM k")
_q("domain_name", lambda c: c.stripped.select("entity_id", text.domain_name(F.col("name_compact_stripped")).alias("domain_name")), "SELECT entity_id, dom AS domain_name FROM k")
_q("strip_accents", lambda c: c.stripped.select("entity_id", "name_stripped", "address_stripped"), "SELECT entity_id, strip_accents(name_norm) AS name_stripped, strip_accents(address_norm) AS address_stripped FROM n")
_q("ascii_view", lambda c: c.n.select("entity_id", text.ascii_view(F.col("name_norm")).alias("name_ascii")), "SELECT entity_id, an AS name_ascii FROM k")
_q("key_index", lambda c: rec.key_index(c.n, "address_norm"), "SELECT source, country_norm, address_norm AS block_key, entity_id FROM n WHERE address_norm <> '' AND country_norm <> ''")
_q("token_stats", lambda c: rec.token_stats(c.n), "SELECT source, country_norm, token, count(*) AS doc_frequency, length(token) AS token_length FROM tn WHERE length(token) >= 2 GROUP BY source, country_norm, token")
_q("token_top25", lambda c: rec.token_stats(c.n).orderBy(F.col("doc_frequency").desc(), "source", "country_norm", "token").limit(25), "SELECT source, country_norm, token, count(*) AS doc_frequency, length(token) AS token_length FROM tn WHERE length(token) >= 2 GROUP BY source, country_norm, token ORDER BY doc_frequency DESC, source, country_norm, token LIMIT 25")
_q("rare_token_index", lambda c: rec.rare_tokens(rec.token_rows(c.n.where("source <> 'S1'"), "name_tokens", drop_numbers=True), 50), "SELECT source, entity_id, country_norm, token, token_freq FROM rn")
_q("strict_rare_tokens", lambda c: rec.rare_tokens(rec.token_rows(c.n.where("source <> 'S1'"), "name_tokens", 5, text.STOP_TOKENS), 20), "SELECT source, entity_id, country_norm, token, token_freq FROM rns")
_q("numeric_anchors", lambda c: rec.number_anchors(rec.normalise(io.sample_anchors(c.spark, c.sf))), "SELECT DISTINCT * FROM (SELECT 'S1' AS source, 'x' AS country_norm, 'S1-' || s_suppkey AS entity_id, unnest(regexp_extract_all(s_name, '[0-9]{5,}')) AS token FROM supplier UNION ALL SELECT 'S2', 'x', 'S2-' || c_custkey, unnest(regexp_extract_all(c_name, '[0-9]{5,}')) FROM customer)")
for _name, _key in (("block_name", "name_norm"), ("block_address", "address_norm"), ("block_address_compact", "address_compact"), ("block_name_compact", "name_compact")):
    _q(_name, lambda c, k=_key, m=_name[6:]: blocking.exact(c.n, k, m), _ALL + "b_" + _name[6:])
_q("block_rare_name_topk", lambda c: blocking.rare_topk(c.n, "name_tokens", "rare_name", drop_numbers=True), _ALL + "b_rare_name")
_q("block_rare_address_topk", lambda c: blocking.rare_topk(c.n, "address_tokens", "rare_address"), _ALL + "b_rare_address")
_q("block_core_name", lambda c: blocking.core_name(c.stripped), _ALL + "b_core_name")
_q("block_domain_name", lambda c: blocking.domain_name(c.stripped), _ALL + "b_domain_name")
_q("block_ascii_exact", lambda c: blocking.ascii_exact(c.n), _ALL + "b_ascii")
_q("block_numeric_anchor", lambda c: blocking.number_anchor(rec.normalise(io.sample_anchors(c.spark, c.sf))), "SELECT DISTINCT 'S1-' || s_suppkey AS source1_entity_id, 'S2-' || c_custkey AS matched_entity_id, 'S2' AS matched_source, 'numeric_anchor' AS block_name FROM supplier JOIN (SELECT * FROM (SELECT c_custkey, regexp_extract(c_name, '[0-9]{5,}') AS t, count(*) OVER (PARTITION BY regexp_extract(c_name, '[0-9]{5,}')) AS f FROM customer) WHERE f <= 100) ON t = regexp_extract(s_name, '[0-9]{5,}') WHERE t <> ''")
_q("block_rare_name_strict", lambda c: blocking.rare_strict(c.n), _ALL + "b_strict")
_q("block_address_overlap", lambda c: blocking.address_overlap(c.n), _ALL + "b_overlap")
_q("union_provenance", lambda c: c.union, _ALL + "uni")
_q("union_count_methods", lambda c: candidates.union_provenance(c.parts(), "rows").select(*io.PAIR, "blocking_mask", "num_blocking_methods", "blocking_methods"), f"SELECT {_P}, blocking_mask, num_blocking_methods, CASE WHEN starts_with(blocking_methods, 'address|') OR blocking_methods = 'address' THEN replace(blocking_methods, '|', '+') ELSE '+' || replace(blocking_methods, '|', '+') END AS blocking_methods FROM uni")
_q("union_distinct_names", lambda c: candidates.union_provenance(c.parts() + [blocking.exact(c.n, "name_compact", "name_compact")], "names"), f"SELECT {_P}, bit_or((CASE block_name WHEN 'address' THEN 1 WHEN 'address_compact' THEN 2 WHEN 'rare_name' THEN 8 WHEN 'rare_address' THEN 16 ELSE 4 END)::INTEGER) AS blocking_mask, count(DISTINCT block_name)::TINYINT AS num_blocking_methods, string_agg(DISTINCT block_name, '|' ORDER BY block_name) AS blocking_methods FROM (" + " UNION ALL ".join(f"SELECT * FROM {b}" for b in [*_BASE, "b_name_compact"]) + f") GROUP BY {_P}")
_q("prune_medium", lambda c: c.pruned, _ALL + "pruned")
_q("prune_provenance", lambda c: candidates.prune_provenance(c.parts()), f"SELECT {_P}, blocking_mask, num_blocking_methods, array_to_string(list_sort(string_split(blocking_methods, '|')), '|') AS blocking_methods FROM uni WHERE num_blocking_methods >= 2 OR blocking_methods = 'name'")
_q("expansion_union", lambda c: c.expansion, _ALL + "expn")
_q("anti_new_candidates", lambda c: candidates.new_over(c.pruned, c.expansion), f"SELECT e.* FROM expn e ANTI JOIN pruned p USING ({_P})")
_q("final_candidates", lambda c: candidates.final_candidates(c.pruned, c.expansion), f"SELECT * FROM pruned UNION ALL SELECT e.* FROM expn e ANTI JOIN pruned p USING ({_P})")
_q("ground_truth_pairs", lambda c: c.truth, _ALL + "truth")
_q("gt_histogram", lambda c: metrics.truth_histogram(c.truth), "SELECT matches, count(*) AS entities FROM (SELECT count(*) AS matches FROM truth GROUP BY source1_entity_id) GROUP BY 1")
_q("candidate_recall", lambda c: metrics.candidate_recall(blocking.exact(c.n, "name_norm", "name"), c.truth), f"SELECT *, {_RATES} FROM (SELECT {_SUMS} FROM {_MARKED.format('b_name')})")
_q("recall_by_source", lambda c: metrics.recall_by_source(c.union, c.truth), f"SELECT *, {_RATES} FROM (SELECT matched_source, {_SUMS} FROM {_MARKED.format('uni')} GROUP BY 1)")
_q("candidates_per_entity_quantiles", lambda c: metrics.per_entity_quantiles(c.union, c.entities), "SELECT count(*) AS entities, round(avg(n), 6) AS avg_candidates, round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.9), 6) AS p90, round(quantile_cont(n, 0.99), 6) AS p99, max(n) AS most, count(*) FILTER (WHERE n = 0) AS without FROM (SELECT count(matched_entity_id) AS n FROM ent LEFT JOIN uni USING (source1_entity_id) GROUP BY source1_entity_id)")
_q("purity_by_mask", lambda c: metrics.purity_by(c.union, c.truth, ["blocking_mask", "blocking_methods"]), f"SELECT blocking_mask, blocking_methods, count(*) AS pairs, count(t.matched_source) AS true_pairs, round(100.0::DOUBLE * count(t.matched_source) / count(*), 6) AS purity FROM (SELECT * FROM uni) u LEFT JOIN (SELECT {_P}, 1 AS x FROM truth) t USING ({_P}) GROUP BY 1, 2".replace("count(t.matched_source)", "count(x)"))
_q("incremental_recall", lambda c: metrics.incremental_recall(blocking.exact(c.n, "name_norm", "name"), c.expansion, c.truth), f"SELECT *, round(100.0::DOUBLE * base_true / true_pairs, 6) AS base_recall, round(100.0::DOUBLE * (base_true + new_true) / true_pairs, 6) AS combined_recall, CASE WHEN new_true > 0 THEN round(new_pairs::DOUBLE / new_true, 6) END AS candidates_per_new_true FROM (SELECT sum(b)::BIGINT AS base_pairs, sum(m)::BIGINT AS experiment_pairs, sum(m * (1 - b))::BIGINT AS new_pairs, sum(m * (1 - b) * t)::BIGINT AS new_true, sum(b * t)::BIGINT AS base_true, sum(t)::BIGINT AS true_pairs, sum(greatest(b, m))::BIGINT AS combined_pairs FROM (SELECT {_P}, max(b) AS b, max(m) AS m, max(t) AS t FROM (SELECT {_P}, 1 AS b, 0 AS m, 0 AS t FROM b_name UNION ALL SELECT {_P}, 0, 1, 0 FROM expn UNION ALL SELECT {_P}, 0, 0, 1 FROM truth) GROUP BY ALL))")
_FEATS = ", ".join(f"round({f}::DOUBLE, 6) AS {f}" if f.endswith(("ratio", "overlap", "jaccard")) else f for f in features.FEATURES)
_q("pair_features", lambda c: _doubles(c.features), f"SELECT {_P}, blocking_mask, num_blocking_methods, blocking_methods, {_FEATS} FROM feat")
_q("jaro_winkler", lambda c: pairs.exact(c.n, "name_norm", "name", ["address_norm"]).select(*io.PAIR, F.round(text.jaro_winkler("a_address_norm", "b_address_norm"), 6).alias("similarity")).where("similarity > 0"), f"SELECT {_P}, round(jaro_winkler_similarity(a.address_norm, b.address_norm), 6) AS similarity FROM b_name JOIN n a ON a.entity_id = source1_entity_id JOIN n b ON b.entity_id = matched_entity_id WHERE jaro_winkler_similarity(a.address_norm, b.address_norm) > 0 AND a.address_norm <> ''")
_q("label_pairs", lambda c: c.labelled.select(*io.PAIR, "label"), f"SELECT {_P}, label FROM lab")
_BUCKET = "(('0x' || substr(md5({0}), 1, 8))::BIGINT % {1})::INTEGER"
_q("split_buckets", lambda c: labels.split(c.union)[1].select(*io.PAIR), f"SELECT {_P} FROM uni WHERE {_BUCKET.format('source1_entity_id', 10)} >= 8")
_q("hard_negatives", lambda c: labels.hardest(c.asked(crowd.Ask(top=3, negative=True)), 3), f"SELECT * FROM (SELECT {_P}, score AS proxy, row_number() OVER (PARTITION BY source1_entity_id, matched_source ORDER BY score DESC, md5(matched_entity_id), matched_entity_id)::INTEGER AS rnk FROM sc WHERE label = 0) WHERE rnk <= 3")
_PB = _BUCKET.format("source1_entity_id || '|' || matched_entity_id", 1000000)
_q("balanced_sample", lambda c: labels.balanced(c.scored).select(*io.PAIR, "label"), f"SELECT {_P}, label FROM sc, (SELECT count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n FROM sc) WHERE label = 1 OR {_PB} < round(least(1.0::DOUBLE, 3.0::DOUBLE * p / n) * 1e6)")
_q("training_matrix", lambda c: labels.matrix_of(c.asked(crowd.Ask(top=3, negative=True, easy=100_000))), f"SELECT {_P}, label FROM (SELECT *, row_number() OVER (PARTITION BY source1_entity_id, matched_source, label ORDER BY score DESC, md5(matched_entity_id), matched_entity_id) AS k FROM sc) WHERE label = 1 OR k <= 3 OR {_PB} < 100000")
_q("entity_sample", lambda c: labels.entity_sample(c.union, 30).select(*io.PAIR), f"SELECT {_P} FROM uni WHERE {_BUCKET.format('source1_entity_id', 100)} < 30")
_q("rule_baseline", lambda c: models.rule_score(c.labelled).select(*io.PAIR, "prediction", "label"), f"SELECT {_P}, CASE WHEN country_exact = 1 AND (name_exact = 1 OR name_compact_exact = 1 OR address_exact = 1 OR address_compact_exact = 1) THEN 1 ELSE 0 END AS prediction, label FROM lab")
_SC = f"SELECT {_P}, score FROM "
_q("decide_threshold", lambda c: decision.threshold(c.asked(crowd.Ask(), F.lit(0.585)), 0.585).select(*io.PAIR, "score"), _SC + "sc WHERE score >= 0.585")
_q("decide_margin", lambda c: decision.margin(c.asked(crowd.Ask(margin=0.05), F.lit(0.5)), 0.5, 0.05).select(*io.PAIR, "score"), _SC + "(SELECT *, max(score) OVER (PARTITION BY source1_entity_id) AS m FROM sc WHERE score >= 0.5) WHERE score >= m - 0.05::DOUBLE")
_q("decide_country_topk", lambda c: decision.country_topk(c.asked(crowd.Ask(top=2), decision.least_of({"de": 0.6, "en": 0.5}, 0.55)), c.stripped, {"de": 0.6, "en": 0.5}, 0.55, 0.05, 2).select(*io.PAIR, "score"), _SC + "(SELECT s.*, max(score) OVER (PARTITION BY source1_entity_id) AS m, row_number() OVER (PARTITION BY source1_entity_id ORDER BY score DESC, matched_entity_id, matched_source) AS r FROM sc s JOIN n ON entity_id = source1_entity_id WHERE score >= CASE country_norm WHEN 'de' THEN 0.6 WHEN 'en' THEN 0.5 ELSE 0.55 END) WHERE score >= m - 0.05::DOUBLE AND r <= 2")
_AD = "(SELECT *, max(score) OVER w AS m, count(*) FILTER (WHERE score >= 0.585) OVER w AS b, count(*) OVER w AS a FROM sc WINDOW w AS (PARTITION BY source1_entity_id)) WHERE score >= "
_LEVEL = "greatest(0.5::DOUBLE, 0.9::DOUBLE * m)"
for _v, _cond in (("standard", "true"), ("a", "b >= 2"), ("b", "a >= 3")):
    _q(f"decide_adaptive_{_v}", lambda c, v=_v: decision.adaptive(c.scored, 0.5, 0.9, v).select(*io.PAIR, "score"), _SC + _AD + f"CASE WHEN {_cond} THEN {_LEVEL} ELSE 0.585::DOUBLE END")
_COUNTS = "(SELECT e.source1_entity_id, coalesce(p, 0) AS p, coalesce(t, 0) AS t, coalesce(tp, 0) AS tp FROM ent e LEFT JOIN (SELECT s.source1_entity_id, count(*) AS p, count(x) AS tp FROM (SELECT * FROM sc WHERE score >= {0}) s LEFT JOIN (SELECT *, 1 AS x FROM truth) USING (" + _P + ") GROUP BY 1) USING (source1_entity_id) LEFT JOIN (SELECT source1_entity_id, count(*) AS t FROM truth GROUP BY 1) USING (source1_entity_id))"
_F = "CASE WHEN p = 0 AND t = 0 THEN 1.0 WHEN tp = 0 THEN 0.0 ELSE 1.25::DOUBLE * tp / (p + 0.25::DOUBLE * t) END"
_q("macro_f05", lambda c: metrics.macro_of_counts(c.at_thresholds([0.585]), c.truth, c.entities), f"SELECT round(avg({_F}), 6) AS macro_f05, round(avg(CASE WHEN p = 0 AND t = 0 THEN 1.0 WHEN p = 0 THEN 0.0 ELSE tp::DOUBLE / p END), 6) AS macro_precision, round(avg(CASE WHEN t = 0 THEN 1.0 ELSE tp::DOUBLE / t END), 6) AS macro_recall, count(*) AS total_entities, count(*) FILTER (WHERE t = 0) AS total_singletons, count(*) FILTER (WHERE t = 0 AND p = 0) AS correct_singletons FROM {_COUNTS.format('0.585')}")
_GRID = [0.3, 0.4, 0.5, 0.585, 0.7, 0.8, 0.9]
_GRID_SQL = " UNION ALL ".join(f"SELECT {t}::DOUBLE AS threshold, count(*) AS entities, sum(tp)::BIGINT AS tp, sum(p - tp)::BIGINT AS fp, sum(t - tp)::BIGINT AS fn, sum(p)::BIGINT AS predicted_pairs, sum(t)::BIGINT AS true_pairs, round(avg({_F}), 6) AS macro_f05, round(avg(CASE WHEN p = 0 THEN 0.0 ELSE tp::DOUBLE / p END), 6) AS macro_precision, round(avg(CASE WHEN t = 0 THEN 0.0 ELSE tp::DOUBLE / t END), 6) AS macro_recall FROM {_COUNTS.format(t)}" for t in _GRID)
_q("threshold_grid", lambda c: metrics.threshold_grid(c.scored, c.truth, c.entities, _GRID), _GRID_SQL)
_q("cardinality_buckets", lambda c: metrics.by_cardinality(decision.threshold(c.scored, 0.585), c.truth, c.entities), f"SELECT CASE WHEN t >= 6 THEN '6+' ELSE t::VARCHAR END AS card_bucket, count(*) AS entity_count, round(avg(p), 6) AS avg_predicted_matches, round(avg({_F}), 6) AS macro_f05 FROM {_COUNTS.format('0.585')} GROUP BY 1")
_PARTS = ["name_char_ratio", "name_token_jaccard", "address_token_jaccard"]
_BL = "(name_char_ratio::DOUBLE * (5 / 10.0::DOUBLE) + name_token_jaccard::DOUBLE * (3 / 10.0::DOUBLE) + address_token_jaccard::DOUBLE * (2 / 10.0::DOUBLE))"
_q("blend_scores", lambda c: metrics.blend(c.features.select(*io.PAIR, *[F.col(p).cast("double").alias(p) for p in _PARTS]), _PARTS, (5, 3, 2)).select(*io.PAIR, F.round("score", 6).alias("score")), f"SELECT {_P}, round({_BL}, 6) AS score FROM feat")
_q("submission_matching", lambda c: submission.result_lists(decision.threshold(c.scored, 0.585), c.entities), f"SELECT source1_entity_id, coalesce(ids, '') AS matched_entity_ids FROM ent LEFT JOIN (SELECT source1_entity_id, string_agg(matched_entity_id, ',' ORDER BY matched_source, matched_entity_id) AS ids FROM sc WHERE score >= 0.585 GROUP BY 1) USING (source1_entity_id)")
_q("submission_candidates", lambda c: submission.result_lists(c.union, c.entities, "candidate_entity_ids"), "SELECT source1_entity_id, coalesce(ids, '') AS candidate_entity_ids FROM ent LEFT JOIN (SELECT source1_entity_id, string_agg(matched_entity_id, ',' ORDER BY matched_source, matched_entity_id) AS ids FROM uni GROUP BY 1) USING (source1_entity_id)")
_cnt = lambda cond, name: f"count(*) FILTER (WHERE {cond}) AS {name}"
_q("normalized_quality", lambda c: quality.records_quality(c.n), "SELECT source, count(*) AS rows, count(*) - count(DISTINCT entity_id) AS repeated_ids, " + ", ".join([_cnt("trim(entity_id) = ''", "empty_ids"), *[_cnt(f"{x} = ''", f"empty_{x}") for x in ("name_norm", "name_compact", "address_norm", "address_compact", "country_norm")], *[_cnt(f"len({x}) = 0", f"empty_{x}") for x in ("name_tokens", "address_tokens")], *[_cnt(f"coalesce({x}, '') = ''", f"missing_{x}") for x in ("business_name", "business_address", "country")]]) + " FROM n GROUP BY 1")
_q("record_gates", lambda c: rec.gates(c.n), "SELECT source, count(*) AS rows, count(DISTINCT entity_id) AS ids, count(*) FILTER (WHERE trim(coalesce(entity_id, '')) = '') AS empty_ids FROM n GROUP BY 1")
_q("profile_missing", lambda c: quality.missing_profile(io.sample_records(c.spark, c.sf)), " UNION ALL ".join(f"SELECT source, '{x}' AS column_name, count(*) AS rows, count(*) FILTER (WHERE coalesce(lower(trim({x})), '') IN ('', 'nan', 'null', 'none', 'n/a', 'na', '-')) AS missing, round(100.0::DOUBLE * count(*) FILTER (WHERE coalesce(lower(trim({x})), '') IN ('', 'nan', 'null', 'none', 'n/a', 'na', '-')) / count(*), 6) AS missing_pct FROM rec GROUP BY 1" for x in ("business_name", "business_address", "country")))
_q("profile_countries", lambda c: quality.top_values(c.n, "country"), "SELECT country AS value, count(*) AS rows FROM rec GROUP BY 1 ORDER BY rows DESC, value LIMIT 20")
_q("profile_frequency", lambda c: quality.frequency_profile(c.n, "name_norm"), "SELECT source, CASE WHEN n = 1 THEN '1' WHEN n <= 5 THEN '2-5' WHEN n <= 20 THEN '6-20' WHEN n <= 100 THEN '21-100' ELSE '100+' END AS band, count(*) AS keys, sum(n)::BIGINT AS records FROM (SELECT source, name_norm, count(*) AS n FROM n WHERE name_norm <> '' GROUP BY 1, 2) GROUP BY 1, 2")
_q("profile_bucket_sizes", lambda c: quality.bucket_sizes(c.n, "name_norm"), "SELECT source, count(*) AS blocks, max(n) AS largest, round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.9), 6) AS p90, round(quantile_cont(n, 0.99), 6) AS p99 FROM (SELECT source, country_norm, name_norm, count(*) AS n FROM n WHERE name_norm <> '' AND country_norm <> '' GROUP BY 1, 2, 3) GROUP BY 1")
_q("profile_tokens", lambda c: rec.token_stats(c.n, "address_tokens").groupBy("token").agg(F.sum("doc_frequency").alias("n")).orderBy(F.col("n").desc(), "token").limit(100), "SELECT token, count(*) AS n FROM ta WHERE length(token) >= 2 GROUP BY 1 ORDER BY n DESC, token LIMIT 100")
_q("profile_prefix", lambda c: quality.prefix_check(c.n), "SELECT source, count(*) AS ids, count(*) FILTER (WHERE NOT starts_with(entity_id, source || '-')) AS wrong_prefix FROM rec GROUP BY 1")
_q("profile_text", lambda c: quality.text_profile(io.sample_records(c.spark, c.sf), "business_name"), r"SELECT source, count(*) AS rows, round(quantile_cont(length(business_name), 0.99), 6) AS length_p99, max(length(business_name))::INTEGER AS length_max, round(quantile_cont(len(list_filter(regexp_split_to_array(business_name, '\s+'), lambda x: x <> '')), 0.99), 6) AS tokens_p99, round(100.0::DOUBLE * count(*) FILTER (WHERE regexp_matches(business_name, '[^\x00-\x7F]')) / count(*), 6) AS non_ascii_pct, round(100.0::DOUBLE * count(*) FILTER (WHERE regexp_matches(business_name, '[0-9]')) / count(*), 6) AS digit_pct, round(100.0::DOUBLE * count(*) FILTER (WHERE business_name <> '' AND upper(business_name) = business_name AND lower(business_name) <> business_name) / count(*), 6) AS upper_pct FROM rec GROUP BY 1")
_q("profile_lists", lambda c: quality.list_profile(submission.result_lists(c.truth, c.entities)), "SELECT count(*) AS rows, count(*) FILTER (WHERE n = 0) AS empty_rows, sum(n)::BIGINT AS matches, round(avg(n), 6) AS avg_matches, max(n) AS most FROM (SELECT count(matched_entity_id) AS n FROM ent LEFT JOIN truth USING (source1_entity_id) GROUP BY source1_entity_id)")
_W = {n: w for n, w in metrics.BLENDS.items() if n in ("a", "c", "third")}
_BLENDED = " UNION ALL ".join(f"SELECT {_P}, '{n}' AS blend, 0.0::DOUBLE + " + " + ".join(f"{p}::DOUBLE * ({x} / {sum(w)}::DOUBLE)" for p, x in zip(_PARTS, w)) + " AS score FROM feat" for n, w in _W.items())
_BY = "(SELECT g.*, e.source1_entity_id, coalesce(p, 0) AS p, coalesce(t, 0) AS t, coalesce(tp, 0) AS tp FROM (SELECT * FROM {grid}) g CROSS JOIN ent e LEFT JOIN (SELECT {key}, s.source1_entity_id, count(*) AS p, count(x) AS tp FROM {chosen} s LEFT JOIN (SELECT *, 1 AS x FROM truth) USING (" + _P + ") GROUP BY ALL) USING ({key}, source1_entity_id) LEFT JOIN (SELECT source1_entity_id, count(*) AS t FROM truth GROUP BY 1) USING (source1_entity_id))"
_MACRO = f"count(*) AS entities, sum(tp)::BIGINT AS tp, sum(p - tp)::BIGINT AS fp, sum(t - tp)::BIGINT AS fn, sum(p)::BIGINT AS predicted_pairs, sum(t)::BIGINT AS true_pairs, round(avg({_F}), 6) AS macro_f05, round(avg(CASE WHEN p = 0 THEN 0.0 ELSE tp::DOUBLE / p END), 6) AS macro_precision, round(avg(CASE WHEN t = 0 THEN 0.0 ELSE tp::DOUBLE / t END), 6) AS macro_recall"
_STEPS = "(VALUES " + ", ".join(f"({t}::DOUBLE)" for t in _GRID) + ") v(threshold)"
_NAMES = "(VALUES " + ", ".join(f"('{n}')" for n in _W) + ") w(blend)"
_q("weight_grid", lambda c: metrics.weight_grid(c.features.select(*io.PAIR, *[F.col(p).cast("double").alias(p) for p in _PARTS]), _PARTS, c.truth, c.entities, _GRID, _W), f"SELECT blend, threshold, {_MACRO} FROM " + _BY.format(grid=f"{_STEPS} CROSS JOIN {_NAMES}", key="blend, threshold", chosen=f"(SELECT * FROM ({_BLENDED}) CROSS JOIN {_STEPS} WHERE score >= threshold)") + " GROUP BY blend, threshold")
_CAL = "(SELECT * FROM (SELECT s.*, c.*, max(score) OVER (PARTITION BY t_de, t_en, delta, top_k, source1_entity_id) AS m, row_number() OVER (PARTITION BY t_de, t_en, delta, top_k, source1_entity_id ORDER BY score DESC, matched_entity_id, matched_source) AS r FROM sc s JOIN n ON entity_id = source1_entity_id CROSS JOIN {grid} c WHERE score >= CASE country_norm WHEN 'de' THEN t_de WHEN 'en' THEN t_en ELSE 0.55::DOUBLE END) WHERE score >= m - delta AND r <= top_k)"
_CALS = "(SELECT * FROM (VALUES (0.5::DOUBLE), (0.6::DOUBLE)) a(t_de), (VALUES (0.45::DOUBLE), (0.585::DOUBLE), (0.7::DOUBLE)) b(t_en), (VALUES (0.05::DOUBLE), (0.2::DOUBLE)) c(delta), (VALUES (1::INTEGER), (8::INTEGER)) d(top_k))"
_q("calibration_grid", lambda c: c.calibrated({"de": [0.5, 0.6], "en": [0.45, 0.585, 0.7]}, [0.05, 0.2], [1, 8], 0.55), f"SELECT t_de, t_en, delta, top_k, {_MACRO} FROM " + _BY.format(grid=_CALS, key="t_de, t_en, delta, top_k", chosen=_CAL.format(grid=_CALS)) + " GROUP BY t_de, t_en, delta, top_k")


def _gbt(c: Context) -> DataFrame:
    train, valid = labels.split(c.labelled)
    return models.predict(models.train(train, rounds=10), valid).select(*io.PAIR, F.round("score", 6).alias("score"))


_q("gbt_scores", _gbt, None)

from tessera.plans import gates as _gates  # noqa: E402,F401  it registers its queries here
