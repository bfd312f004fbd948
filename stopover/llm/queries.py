"""One query for each operator, on the whole documents, and its SQL where there is one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopover.llm import (
    adaptive_rules, centroids, divergence, language, lattice, mixing, packing, pii, prefix_counts,
    quality, simhash, token_files, winnowing)
from stopover.llm.common import crc32, documents
from stopover.session import fresh_path

# Parameters of the queries; the pipeline uses the same.
BYTE_TOKENIZER, WORD_TOKENIZER = "byte_bpe_50k.json", "word_bpe_49k.json"
SIZE, END = 2048, 0
BUDGETS = [512, 2048, 8192]
SHARE, WEIGHTS, SEED = 1.5, [5, 2, 1], 0
SHINGLE, HASH_SEED, BITS = 4, 42, 4
KEEP_ABOVE = 0.3
PIECES = "piece_bpe_32k.model"
TERM_DOCUMENTS, TERM_RANKS = 10, 10
CLUSTERS, ROUNDS, CLUSTER_SEED, DIMS = 8, 10, 3, 64


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def learns_language() -> Column:
    return crc32(F.col("doc_id")) % 4 != 2


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compared_with_edited(documents(spark, sf_dir))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.fit(docs, learns_language())
    return language.predicted(docs, model).select(
        "doc.doc_id", (crc32(F.col("doc.doc_id")) % 4 == 2).alias("held_out"), "lang_pred",
        "score", "rejected")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = pii.found(docs, pii.fit(docs))
    counts = [F.regexp_count("base", F.lit(f"{kind}:")).cast("long").alias(f"n_{kind}")
              for kind in pii.KINDS]
    return found.select("doc.doc_id", *counts,
                        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"),
                        crc32(F.col("doc_id")) % 5 != 0)
    return quality.scored(docs, model).select(
        "doc.doc_id", (crc32(F.col("doc.doc_id")) % 5 == 0).alias("held_out"), "score",
        (F.col("score") >= KEEP_ABOVE).cast("int").alias("predicted"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.repetitions(documents(spark, sf_dir), SHARE, WEIGHTS, SEED).select(
        "doc.doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), SHINGLE, HASH_SEED, BITS).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = token_files.write_token_files(
        documents(spark, sf_dir), fresh_path(spark, "tokens"), tokenizer_path(BYTE_TOKENIZER),
        SIZE, END)
    return token_files.read_token_files(spark, written)


def op8_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adaptive_rules.judged(documents(spark, sf_dir)).select(
        "doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op9_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = prefix_counts.stored(documents(spark, sf_dir), tokenizer_path(WORD_TOKENIZER))
    return prefix_counts.answered(tables, BUDGETS).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > SIZE).alias("over_limit"),
        *[f"fits_{budget}" for budget in BUDGETS])


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(
        documents(spark, sf_dir), tokenizer_path(WORD_TOKENIZER), SIZE, END)


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir), TERM_DOCUMENTS, TERM_RANKS)


def op12_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = crc32(F.col("doc_id")) % 7
    scored = lattice.scored(
        documents(spark, sf_dir), remainder != 2, tokenizer_path(PIECES), ["doc_id"])
    return scored.select(
        "doc.doc_id", (crc32(F.col("doc.doc_id")) % 7 == 2).alias("held_out"), "n_tokens",
        "n_known", "train_tokens", "base_score", "score")


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(
        spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", CLUSTERS,
        ROUNDS, CLUSTER_SEED, DIMS)


QUERIES = {
    name: query for name, query in globals().items()
    if name.startswith("op") and name[2:].split("_")[0].isdigit()}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_MIXING = rf"""
with sized as (select doc_id, source, len({_WORDS})::bigint as size,
    coalesce(doc_id::varchar, 'null') || ':' || md5(coalesce(text, '')) as name,
    row_number() over (partition by doc_id, source, md5(coalesce(text, ''))) - 1 as number
    from documents),
sources as (select source, sum(size)::bigint as source_size from sized group by source),
weighted as (select *, [5.0::double, 2.0::double, 1.0::double][
    ((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight from sources),
bounds as (select *, 2.0::double * source_size / weight as bound from weighted),
levels as (select *, (1.5::double * sum(source_size) over ()::bigint - 2.0::double * coalesce(
        sum(source_size) over (order by bound, source nulls last
        rows between unbounded preceding and 1 preceding)::bigint, 0))
    / (sum(weight) over () - coalesce(sum(weight) over (order by bound, source nulls last
        rows between unbounded preceding and 1 preceding), 0)) as level from bounds),
targets as (select source, source_size, case when c < bound then c * weight
    else 2.0::double * source_size end as target from (
    select *, max(case when level < bound then level end) over () as c from levels)),
rated as (select doc_id, size, source_size, target,
    case when source_size > 0 then target / source_size else 0.0 end as rate,
    ('0x' || substr(md5(name || ':' || number || ':0'), 1, 13))::bigint::double
        / 4503599627370496.0::double as draw
    from sized join targets on sized.source is not distinct from targets.source)
select doc_id, size, source_size, target,
    size * (floor(rate)::bigint + (draw < rate - floor(rate))::bigint) as taken from rated
"""

_RULES = rf"""
with docs as (select row_number() over () as row, doc_id, lang, source, coalesce(text, '') as text
    from documents),
words as (select row, doc_id, lang, source, text, {_WORDS} as w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
    from docs),
windows as (select row, unnest(range(1, len(w) - 1)) as p, w from words where len(w) >= 3),
grams as (select row, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] as gram from windows),
twice as (select row, p from grams qualify count(*) over (partition by row, gram) > 1),
covered as (select row, count(distinct place) as n_repeat_words from (
    select row, p + unnest([0, 1, 2]) as place from twice) group by row),
measured as (select row, doc_id, lang, source, len(w)::bigint as n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
    len(regexp_extract_all(text, '[A-Z]'))::bigint as n_upper,
    len(lines)::bigint as n_lines,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words
    from words left join covered using (row)),
buckets as (select row, lang, source, unnest(['symbols', 'upper', 'dup_lines', 'repeat_words',
        'word_length']) as measure,
    unnest([n_symbols * 1000 // nullif(word_chars, 0), n_upper * 1000 // nullif(word_chars, 0),
        n_dup_lines * 1000 // nullif(n_lines, 0), n_repeat_words * 1000 // nullif(n_words, 0),
        word_chars * 10 // nullif(n_words, 0)]) as raw from measured),
valued as (select row, lang, source, measure, coalesce(raw, 0)::bigint as value from buckets),
bucketed as (select *, (value >> more) << more as bucket from (select *, greatest(
    length(bin(value)) - {adaptive_rules.DIGITS}, 0)::bigint as more from valued)),
levels as (select b, case when b > 0 then lang end as lang, case when b > 1 then source end as source,
    measure, bucket, count(*) as n from bucketed, (select unnest([0, 1, 2]) as b)
    group by all),
ranked as (select *, sum(n) over (partition by b, lang, source, measure order by bucket) as below,
    sum(n) over (partition by b, lang, source, measure) as total from levels),
fences as (select b, lang, source, measure, max(total) as total,
    min(case when below * 4 >= total * 3 then bucket end) as upper,
    min(case when below * 2 >= total then bucket end) as half from ranked group by all),
limits as (select *, upper + {adaptive_rules.SPREADS} * (upper - half) + case measure
    {' '.join(f"when '{m}' then {v[3]}" for m, v in adaptive_rules.MEASURES.items())} end as fence
    from fences),
above as (select x.row, bool_or(x.value > case
        when o.total >= {adaptive_rules.ENOUGH} then o.fence
        when l.total >= {adaptive_rules.ENOUGH} then l.fence else e.fence end) as above
    from bucketed x
    join limits o on o.b = 2 and o.measure = x.measure
        and o.lang is not distinct from x.lang and o.source is not distinct from x.source
    join limits l on l.b = 1 and l.measure = x.measure and l.lang is not distinct from x.lang
    join limits e on e.b = 0 and e.measure = x.measure group by x.row)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and not above as kept
from measured join above using (row)
"""

_DIVERGENCE = rf"""
with docs as (select coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
grouped as (select distinct lang, source from docs),
vocabulary as (select lang, term from (select lang, unnest(list_distinct(terms)) as term from docs)
    group by all having count(*) >= {TERM_DOCUMENTS}),
used as (select lang, source, term, count(*)::hugeint as n
    from (select lang, source, unnest(terms) as term from docs)
    join vocabulary using (lang, term) group by all),
sizes as (select lang, count(*)::hugeint as v from vocabulary group by lang),
totals as (select lang, source, sum(n)::hugeint as total from used group by all),
langs as (select lang, sum(n)::hugeint as total from used group by lang),
priced as (select g.lang, g.source, term, coalesce(n, 0) as n,
    1 + (1000000000 * (coalesce(n, 0) + 2)) // (coalesce(total, 0) + 2 * v) as p
    from grouped g join vocabulary using (lang) join sizes using (lang)
    left join used using (lang, source, term) left join totals using (lang, source)),
expected as (select lang, term, 1 + (1000000000 * (sum(n)::hugeint + 2)) // (any_value(total)
        + 2 * any_value(v)) as q
    from used join langs using (lang) join sizes using (lang) group by lang, term),
far as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))
        as value
    from priced a join priced b on a.lang = b.lang and a.term = b.term and a.source <> b.source
    group by all),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
    from grouped a join grouped b on a.lang = b.lang and a.source <> b.source
    left join far f on f.lang = a.lang and f.source = a.source and f.item = b.source),
loud as (select lang, source, 'term' as part, term as item, (p - q) * (p - q) // (p + q) as value
    from priced join expected using (lang, term) where n > 0 and p > q)
select lang, source, part, item, value::bigint as value, row_number() over (
    partition by lang, source, part order by value desc, item)::int as rank
from (select * from pairs union all select * from loud)
qualify part = 'pair' or rank <= {TERM_RANKS}
"""


def _rounds(vector: str, k: int, rounds: int, seed: int, dims: int) -> str:
    """Exact k-means as SQL, one materialised step after another."""
    steps = [f"""kept as materialized (select row_number() over () as row, vec_id,
        list_transform({vector}, lambda x: floor(1024 * x::double)::hugeint) as x from embeddings
        where len({vector}) = {dims} and len(list_filter({vector},
            lambda x: x is null or not isfinite(x))) = 0)""",
             f"""centre0 as materialized (select row_number() over (order by hash, x) - 1 as cluster, x
        from (select x, sha256('{seed}:' || coalesce(vec_id::varchar, '')) as hash from kept)
        order by hash, x limit {k})"""]
    for n in range(rounds + 1):
        steps.append(f"""near{n} as materialized (select row, any_value(x) as x, any_value(vec_id) as vec_id,
            min_by(cluster, (distance, cluster)) as cluster, min(distance) as distance
        from (select k.row, k.x, k.vec_id, c.cluster, list_sum(list_transform(list_zip(k.x, c.x),
            lambda z: (z[1] - z[2]) * (z[1] - z[2])))::hugeint as distance
            from kept k, centre{n} c) group by row)""")
        if n < rounds:
            steps.append(f"""centre{n + 1} as materialized (select cluster, coalesce(m.x, c.x) as x
        from centre{n} c left join (select cluster, list(mean order by place) as x from (
            select cluster, place, (s - ((s % n) + n) % n) // n as mean from (
                select cluster, place, sum(v)::hugeint as s, count(*)::hugeint as n from (
                    select cluster, unnest(x) as v, unnest(range(1, {dims} + 1)) as place from near{n})
                group by all)) group by cluster) m using (cluster))""")
    return f"""with {", ".join(steps)}
select vec_id, cluster::int as cluster, distance::bigint as distance,
    (sum(distance) over (partition by cluster))::bigint as cluster_inertia,
    (sum(distance) over ())::bigint as inertia,
    sha256(array_to_string(c.x, ',')) as centroid_sha256
from near{rounds} join centre{rounds} c using (cluster)"""


ORACLE = {
    "op5_mixing": _MIXING, "op8_adaptive_rules": _RULES, "op11_divergence": _DIVERGENCE,
    "op13_centroids": _rounds("embedding", CLUSTERS, ROUNDS, CLUSTER_SEED, DIMS)}
