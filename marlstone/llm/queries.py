"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, dedup, divergence, drake, html, jaccard, license, mixing, pii, ppm, quality, tokens
from .common import remainder, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), pii.key_of(spark))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(documents, labels, condition=remainder(F.col("doc_id"), 5) != 0)
    scored = quality.score(documents, model, {"doc_id": documents["doc_id"]})
    return scored.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op3_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = mixing.mix_decisions(table(spark, sf_dir, "documents"))
    return decided.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op5_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("matches")


def op6_pfor_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_table(table(spark, sf_dir, "documents"), TOKENIZER)


def op7_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_text(table(spark, sf_dir, "pages"))


def op9_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = ppm.lm_scores(documents, train=remainder(documents["doc_id"], 7) != 2)
    return scored.select("doc_id", (remainder(F.col("doc_id"), 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


def op11_drake_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drake.cluster_report(table(spark, sf_dir, "embeddings")).drop("moved_in")


def op12_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), TOKENIZER), TOKENIZER))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_pii_pseudonyms, op2_quality_rules, op3_systematic_mix, op4_exact_dedup, op5_suffix_decontamination, op6_pfor_tokens, op7_license_diagonals, op8_html_text, op9_ppm_scores,
        op10_jaccard_join, op11_drake_clusters, op12_bpe_transducer, op13_source_divergence,
    )
    return {f.__name__: f for f in found}


OP3_SQL = r"""
with docs as (
  select doc_id, source, length(regexp_replace(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', 'w', 'g'), '[\x20\x09-\x0D]+', '', 'g'))::bigint as size
  from documents
), laid as (
  select *, lpad(length(bin(size))::varchar, 2, '0') || substr(bin(size), 1, 4) as class, md5(coalesce(doc_id::varchar, '')) as key from docs
), ranked as (
  select source, sum(size)::bigint as source_size,
    [3, 1, 2][(row_number() over (order by source is null, source) - 1) % 3 + 1]::bigint as w
  from docs group by source
), full_ as (
  select *, 2 * source_size as cap,
    sum(source_size) over () * 1.5::double - coalesce(sum(2 * source_size) over before_, 0) as left_words,
    (sum(w) over () - coalesce(sum(w) over before_, 0))::bigint as left_weight
  from ranked
  window before_ as (order by (2 * source_size)::double / w, source is null, source rows between unbounded preceding and 1 preceding)
), open_ as (
  select *, cap::double * left_weight > left_words::double * w as is_open from full_
), level as (
  select max(left_words::double) filter (is_open) as words, max(left_weight) filter (is_open) as weight from open_
), targets as (
  select source, source_size, case when is_open then w * words / weight else cap::double end as target from open_, level
), placed as (
  select l.doc_id, l.size, t.source_size, t.target,
    case when t.source_size > 0 then t.target / t.source_size else 0.0::double end as rate,
    row_number() over (partition by l.source order by class, substr(key, 1, 2), key, doc_id, size) as rank
  from laid l join targets t on l.source is not distinct from t.source
)
select doc_id, size, source_size, target,
  ((floor(rate * rank + @offset::double) - floor(rate * (rank - 1) + @offset::double))::bigint * size)::bigint as taken
from placed
""".replace("@offset", repr(mixing.drawn_offset()))

OP4_SQL = r"""
with docs as (
  select doc_id, length(coalesce(text, '')) as n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256 from documents
), best as (
  select *, first_value(doc_id) over (partition by text_sha256 order by n desc, doc_id nulls last) as keep_id,
    count(*) over (partition by text_sha256) as group_size,
    row_number() over (partition by text_sha256 order by n desc, doc_id nulls last) as place
  from docs
)
select doc_id, keep_id, group_size, place = 1 as kept, text_sha256 from best
"""

OP5_SQL = r"""
with doc_words as (
  select row_number() over () as uid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), item_words as (
  select coalesce(item_id::varchar, '') as item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), item_grams as (
  select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as gram
  from (select item_id, w, least(len(w), 13) as n, unnest(range(1, len(w) - least(len(w), 13) + 2)) as i from item_words where len(w) > 0)
), doc_grams as (
  select uid, n, i, array_to_string(w[i:i + n - 1], ' ') as gram
  from (select uid, w, n, unnest(range(1, len(w) - n + 2)) as i from doc_words, (select distinct n from item_grams) where len(w) >= n)
), hits as (
  select uid, i, n, item_id from doc_grams join item_grams using (n, gram)
), words_hit as (
  select uid, count(distinct p) as n_hit from (select uid, unnest(range(i, i + n)) as p from (select distinct uid, i, n from hits)) group by uid
), items_hit as (
  select uid, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as items from hits group by uid
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc_words left join words_hit using (uid) left join items_hit using (uid)
"""

OP7_SQL = r"""
with templates (template, base, label, k, grams, drift, spot, gram) as (values
  @templates
), facts (template, family, tests) as (values
  @facts
), words as (
  select row_number() over () as uid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), grams as (
  select uid, k, i - 1 as place, array_to_string(w[i:i + k - 1], ' ') as gram
  from (select uid, w, k, unnest(range(1, len(w) - k + 2)) as i from words, (select distinct k from templates) where len(w) >= k)
), lines as (
  select uid, template, any_value(base) as base, any_value(label) as label, any_value(t.grams) as grams, any_value(drift) as drift, any_value(k) as k, place - spot as diagonal,
    list(distinct spot) as spots, count(distinct spot) as votes
  from grams join templates t using (k, gram) group by uid, template, place - spot
), merged as (
  select *, list_distinct(flatten(list(spots) over near)) as hits, max(votes * 1000000000 - diagonal) over near as best, min(diagonal + list_min(spots)) over near as start_, max(diagonal + list_max(spots) + k) over near as end_
  from lines
  window near as (partition by uid, template order by diagonal * 1000000 // drift range between 1000000 preceding and 1000000 following)
), judged as (
  select *, row_number() over () as span, len(hits)::double / grams as share, base and votes = grams as exact,
    not base and best = votes * 1000000000 - diagonal and len(hits)::double / grams >= 0.6 and len(list_filter(tests, lambda t: len(list_intersect(t.spots, hits)) < t.need)) = 0 as passed
  from merged join facts using (template)
), beaten as (
  select distinct a.span from judged a join judged b on a.uid = b.uid and a.family = b.family and a.label <> b.label and a.passed and b.passed and b.start_ < a.end_ and a.start_ < b.end_
  where len(b.hits) > len(a.hits) or (len(b.hits) = len(a.hits) and b.template < a.template)
), spans as (
  select *, passed and span not in (select span from beaten) as merged from judged
), found as (
  select uid, count(*) filter (exact) as n_base, min(diagonal) filter (exact) as first_word, max(diagonal) filter (exact) as last_word,
    string_agg(distinct label, ',' order by label) filter (exact) as base_labels, string_agg(distinct label, ',' order by label) filter (exact or merged) as labels,
    max(case when exact then 1.0::double when merged then share end) as score
  from spans group by uid
)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0)::double as score
from words left join found using (uid)
""".replace("@facts", ",\n  ".join(f"({t}, {family}, {[{'spots': list(spots), 'need': need} for spots, need in tests] or '[]::struct(spots int[], need int)[]'})" for t, family, tests in license.template_facts(license.template_rows()))).replace("@templates", ",\n  ".join(f"({t}, {str(base).lower()}, '{label}', {k}, {grams}, {drift}, {at}, '{gram}')" for t, base, label, k, grams, drift, at, gram in license.template_rows()))

OP10_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), shingles as (
  select distinct doc_id, array_to_string(w[i:i + 3], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as i from words where len(w) > 0)
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), shared as (
  select x.doc_id as a, y.doc_id as b, count(*) as common from shingles x join shingles y using (s) where x.doc_id <> y.doc_id group by all
), links as (
  select a, b, common = x.n and common = y.n as equal from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * common >= 85 * (x.n + y.n - common)
), classes as (
  select d.doc_id, least(d.doc_id, coalesce(min(b) filter (equal), d.doc_id)) as class from sizes d left join links on a = d.doc_id group by d.doc_id
), degrees as (
  select a as doc_id, count(distinct class) as n_links from links join classes on classes.doc_id = b where not equal group by a
), reached as (
  select doc_id as a, doc_id as b from sizes
  union
  select reached.a, links.b from reached join links on links.a = reached.b
), components as (
  select a as doc_id, min(b) as component_id from reached group by a
)
select w.doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(component_id, w.doc_id) as component_id, coalesce(n_links, 0)::bigint as n_links
from words w left join sizes using (doc_id) left join components using (doc_id) left join degrees using (doc_id)
"""



def op11_sql(rounds: int = drake.ROUNDS, k: int = drake.CENTROIDS, dimensions: int = drake.DIMENSIONS, scale: int = drake.SCALE) -> str:
    """Every round measures every vector; a round is two tables, the assignment and the new centroids."""
    assign = """select vec_id, x, list_position(d, list_min(d)) as cluster, list_min(d) as distance from (
  select vec_id, x, list_transform(c, lambda y: list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint) as d from kept, {centroids})"""
    steps = [f"""kept as materialized (
  select vec_id, list_transform(embedding, lambda v: floor({scale} * v::double)::bigint) as x from embeddings
  where len(embedding) = {dimensions} and len(list_filter(embedding, lambda v: v is not null and isfinite(v))) = {dimensions}
), c0 as materialized (
  select list(x order by key, x) as c from (select x, sha256(concat('3:', vec_id)) as key from kept order by key, x limit {k})
)"""]
    for n in range(rounds):
        steps.append(f"""a{n} as materialized ({assign.format(centroids=f"c{n}")}
), c{n + 1} as materialized (
  select list(x order by cluster) as c from (
    select cluster, list(m order by dim) as x from (
      select i as cluster, dim, case when max(n) is null then max(old) else (max(s) - ((max(s) % max(n)) + max(n)) % max(n)) // max(n) end::bigint as m from (
        select i, dim, c[i][dim] as old from c{n}, (select unnest(range(1, {k} + 1)) as i), (select unnest(range(1, {dimensions} + 1)) as dim) where i <= len(c)
      ) left join (
        select cluster as i, dim, sum(v)::hugeint as s, count(*)::hugeint as n from (select cluster, unnest(x) as v, unnest(range(1, {dimensions} + 1)) as dim from a{n}) group by cluster, dim
      ) using (i, dim) group by i, dim
    ) group by cluster
  )
)""")
    return "with " + ", ".join(steps) + f""", last_ as ({assign.format(centroids=f"c{rounds}")})
select vec_id, (cluster - 1)::int as cluster, distance, (sum(distance) over (partition by cluster))::bigint as cluster_inertia, (sum(distance) over ())::bigint as inertia,
  sha256(array_to_string(c[cluster], ',')) as centroid_sha256
from last_, c{rounds}
"""


OP13_SQL = r"""
with docs as (
  select row_number() over () as uid, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents
), groups as (select distinct lang, source from docs
), words as (select uid, lang, source, unnest(w) as term from docs
), kept as (select lang, term from words group by all having count(distinct uid) >= 30
), sizes as (select lang, count(*) as v from kept group by lang
), counts as (select lang, source, term, count(*) as n from words join kept using (lang, term) group by all
), cells as (
  select g.lang, g.source, k.term, coalesce(n, 0) as n from groups g join kept k using (lang) left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
), shares as (
  select lang, source, term, n, 1 + (1000000000::hugeint * (n + 5)) // ((sum(n) over (partition by lang, source))::hugeint + 5 * v) as p from cells join sizes using (lang)
), whole as (
  select lang, term, 1 + (1000000000::hugeint * (n + 5)) // ((sum(n) over (partition by lang))::hugeint + 5 * v) as q
  from (select lang, term, sum(n) as n from cells group by all) join sizes using (lang)
), pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join (select x.lang, x.source as s, y.source as t, sum(abs(x.p - y.p)) as value from shares x join shares y using (lang, term) where x.source <> y.source group by all) d
    on d.lang = a.lang and d.s = a.source and d.t = b.source
), terms as (
  select lang, source, 'term' as part, term as item, (p - q)::bigint as value from shares join whole using (lang, term) where n > 0 and p > q
)
select lang, source, part, item, value, (row_number() over (partition by lang, source, part order by value desc, encode(item)))::int as rank
from (select * from pairs union all select * from terms) qualify part = 'pair' or rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_systematic_mix": OP3_SQL, "op4_exact_dedup": OP4_SQL, "op5_suffix_decontamination": OP5_SQL, "op7_license_diagonals": OP7_SQL, "op10_jaccard_join": OP10_SQL, "op11_drake_clusters": op11_sql(), "op13_source_divergence": OP13_SQL}
