"""The registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkit.llm import (
    covertree,
    divergence,
    mixing,
    neardup,
    packing,
    pieces,
    pii,
    quality,
    repeats,
    tokenfiles,
    topk,
    urlrules,
    vantage,
)
from feedkit.plans.settle import shared_folder


def small_batches(spark: SparkSession) -> None:
    """Whole texts are long rows: a thousand of them are enough for an Arrow batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_nb_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality.train(docs, labels, ~quality.held_out(F.col("doc_id")))
    return quality.score(docs, model).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op2_semi_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


def op3_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), width=4, percent=80)


def op4_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, _ = packing.pack(_table(spark, sf_dir, "documents"), tokenizer_file(), end_id=1)
    return placed


def op5_block_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0, k=20)


def op6_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.9)


def op7_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixing.in_order(mixed).select(
        "doc_id", "size", "source_size", "target", "taken", "positions"
    )


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "token-files")
    tokenfiles.write_tokens(_table(spark, sf_dir, "documents"), folder, tokenizer_file(), end_id=2)
    return tokenfiles.read_checksums(spark, folder)


def op9_suffix_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, sf_dir, "documents"))


HOST_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judge_urls(
        _table(spark, sf_dir, "pages"),
        [urlrules.host_rule(*r) for r in HOST_RULES],
        [urlrules.pattern_rule(*r) for r in urlrules.PATTERNS],
    )


def op11_vantage_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage.cluster(_table(spark, sf_dir, "embeddings"), k=8, rounds=10)


def op12_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = pieces.encode_texts(_table(spark, sf_dir, "documents"), piece_file(), with_text=True)
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_stripes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"), least_docs=3, top=200)


QUERIES = {
    "op2_semi_crf": op2_semi_crf,
    "op1_nb_svm": op1_nb_svm,
    "op6_cover_tree": op6_cover_tree,
    "op5_block_top_k": op5_block_top_k,
    "op9_suffix_groups": op9_suffix_groups,
    "op3_tensored_minhash": op3_tensored_minhash,
    "op7_curriculum_mix": op7_curriculum_mix,
    "op4_bin_slack": op4_bin_slack,
    "op8_token_files": op8_token_files,
    "op10_url_rules": op10_url_rules,
    "op11_vantage_point": op11_vantage_point,
    "op12_merge_rounds": op12_merge_rounds,
    "op13_stripes": op13_stripes,
}

_OP10 = """
with a as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), b as (
  select page_id, rest, regexp_extract(rest, '^[^/?#]*') as h from a
), c as (
  select page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') as path from b
), d as (
  select *, case
    when ('.' || host) like '%.www.example.com' and starts_with(path, '/en/') then 'www.example.com/en/'
    when ('.' || host) like '%.example.com' and starts_with(path, '/en/') then 'example.com/en/'
    when ('.' || host) like '%.net' and starts_with(path, '/es/') then 'net/es/'
    when ('.' || host) like '%.net' and starts_with(path, '/fr/') then 'net/fr/'
    when ('.' || host) like '%.com' and starts_with(path, '/') then 'com/' end as rule,
    case
    when regexp_matches(lower(host), '^(.*[.])?cheap-pills[.]') then '||cheap-pills.'
    when regexp_matches(lower(host), '^(.*[.])?casino-win[.]') then '||casino-win.'
    when regexp_matches(lower(host), '^(.*[.])?free-bets[.]') then '||free-bets.'
    when contains(lower(host || path), '.adserver.') then '*.adserver.*'
    when contains(lower(host || path), '/ads/') then '*/ads/*' end as pattern from c
)
select page_id, host, path, rule, pattern, case
  when rule in ('com/', 'www.example.com/en/') then 'allow'
  when rule is not null or pattern is not null then 'block' else 'allow' end as verdict from d
"""

_OP5 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as e
  from embeddings where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), s as (
  select q.vec_id as query_id, d.vec_id,
    cast(list_inner_product(cast(q.e as double[]), cast(d.e as double[])) as bigint) as score
  from v q join v d on q.vec_id <> d.vec_id and len(q.e) = len(d.e) where q.vec_id % 20 = 0
)
select query_id, cast(row_number() over w as integer) as rank, vec_id, score from s
window w as (partition by query_id order by score desc, vec_id) qualify row_number() over w <= 20
"""


def _op11_sql(k: int = 8, rounds: int = 10) -> str:
    """The rounds written out one after the other."""
    far = (
        "cast(list_sum(list_transform(list_zip(v.e, c.e), lambda x: cast((x[1] - x[2]) * (x[1] - x[2]) as bigint))) as bigint)"
    )
    nearest = (
        "a{i} as materialized (select v.rid, v.vec_id, v.e, arg_min(c.cluster, (d.far, c.cluster)) as cluster, min(d.far) as distance "
        "from v, c{i} c, lateral (select " + far + " as far) d group by all)"
    )
    mean = "cast((s - ((s % n) + n) % n) // n as bigint)"  # rounded down also below zero
    parts = [
        """v as materialized (
  select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as e
  from embeddings where len(embedding) = 64
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0)""",
        f"""c0 as materialized (
  select cast(row_number() over (order by sha256('3:' || vec_id), vec_id, e) - 1 as integer) as cluster, e from v
  qualify row_number() over (order by sha256('3:' || vec_id), vec_id, e) <= {k})""",
    ]
    for i in range(rounds):
        parts.append(nearest.format(i=i))
        parts.append(
            f"""m{i} as materialized (
  select cluster, list({mean} order by nth) as e from (
    select cluster, nth, sum(x) as s, count(*) as n
    from (select cluster, unnest(e) as x, generate_subscripts(e, 1) as nth from a{i}) group by all) group by cluster),
c{i + 1} as materialized (select c.cluster, coalesce(m.e, c.e) as e from c{i} c left join m{i} m using (cluster))"""
        )
    parts.append(nearest.format(i=rounds))
    return (
        "with "
        + ",\n".join(parts)
        + f"""
select a.vec_id, a.cluster, a.distance, cast(sum(distance) over (partition by a.cluster) as bigint) as cluster_inertia,
  cast(sum(distance) over () as bigint) as inertia, sha256(array_to_string(c.e, ',')) as centroid_sha256
from a{rounds} a join c{rounds} c using (cluster)"""
    )


_OP13 = """
with d as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
), w as (
  select lang, source, row, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from d
), kept as materialized (
  select lang, term, count(*) as n from w group by lang, term having count(distinct row) >= 3
), groups as materialized (select distinct lang, source from d
), counts as materialized (
  select w.lang, w.source, w.term, count(*) as n from w join kept using (lang, term) group by all
), v as (select lang, count(*) as v, sum(n) as n from kept group by lang
), totals as (
  select g.lang, g.source, coalesce(sum(c.n), 0) as n from groups g left join counts c using (lang, source) group by all
), p as materialized (
  select k.lang, g.source, k.term, coalesce(c.n, 0) as n,
    1 + (1000000000 * (cast(coalesce(c.n, 0) as hugeint) + 1)) // cast(g.n + v.v as hugeint) as p
  from kept k join v using (lang) join totals g using (lang) left join counts c using (lang, source, term)
), q as (
  select k.lang, k.term, 1 + (1000000000 * (cast(k.n as hugeint) + 1)) // cast(v.n + v.v as hugeint) as q
  from kept k join v using (lang)
), pairs as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
  from p a join p b using (lang, term) where a.source <> b.source group by all
), found as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(x.value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join pairs x on x.lang = a.lang and x.source = a.source and x.item = b.source
  union all
  select lang, source, 'term', term, ((p - q) * (p - q)) // q from p join q using (lang, term) where n > 0 and p > q
)
select lang, source, part, item, cast(value as bigint) as value,
  cast(row_number() over w as integer) as rank from found
window w as (partition by lang, source, part order by value desc, encode(item))
qualify part = 'pair' or row_number() over w <= 200
"""

_OP3 = """
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') as w from documents
), s as materialized (
  select distinct doc_id, case when len(w) < 4 then array_to_string(w, ' ') else array_to_string(w[i : i + 3], ' ') end as shingle
  from w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) u(i) where len(w) > 0
), n as materialized (select doc_id, count(*) as n from s group by doc_id
), p as materialized (
  select x.doc_id as a, y.doc_id as b, count(*) as c from s x join s y using (shingle) where x.doc_id <> y.doc_id group by all
), l as materialized (
  select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * c >= 80 * (na.n + nb.n - c)
), r as (select doc_id, doc_id as seen from documents union select r.doc_id, l.b from r join l on l.a = r.seen)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, c.component_id, d.doc_id = c.component_id as kept
from documents d left join n using (doc_id) join (select doc_id, min(seen) as component_id from r group by doc_id) c using (doc_id)
"""

_OP6 = """
with recursive v as materialized (
  select vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), m as materialized (select vec_id, e, sqrt(list_dot_product(e, e)) as size from v where list_dot_product(e, e) > 0
), l as materialized (
  select x.vec_id as a, y.vec_id as b from m x join m y on x.vec_id <> y.vec_id and len(x.e) = len(y.e)
  where list_dot_product(x.e, y.e) / (x.size * y.size) >= 0.9
), r as (select vec_id, vec_id as seen from embeddings union select r.vec_id, l.b from r join l on l.a = r.seen)
select d.vec_id, coalesce(k.n, 0)::bigint as n_links, c.component_id, d.vec_id = c.component_id as kept
from embeddings d left join (select a, count(*) as n from l group by a) k on k.a = d.vec_id
join (select vec_id, min(seen) as component_id from r group by vec_id) c using (vec_id)
"""

_OP9 = """
with d as materialized (select doc_id, encode(coalesce(text, '')) as t, octet_length(encode(coalesce(text, ''))) as n from documents
), s as materialized (
  select doc_id, i, md5(t[i + 1 : i + 200]) as h from d, unnest(range(n - 199)) u(i) where n >= 200
), twice as (select h from s group by h having count(*) > 1
), hit as (select doc_id, i from s join twice using (h)
), marked as (
  select doc_id, i, case when i > lag(i) over (partition by doc_id order by i) + 200 then 1 else 0 end as opens from hit
), numbered as (select *, sum(opens) over (partition by doc_id order by i) as run from marked
), runs as (select doc_id, run, min(i) as a, max(i) + 200 as b from numbered group by all
), kept as (
  select doc_id, a, t[coalesce(lag(b) over w, 0) + 1 : a] as part from runs join d using (doc_id) window w as (partition by doc_id order by a)
  union all
  select d.doc_id, d.n + 1, t[coalesce(m.b, 0) + 1 : d.n] from d left join (select doc_id, max(b) as b from runs group by doc_id) m using (doc_id)
), joined as (select doc_id, sha256(unhex(string_agg(hex(part), '' order by a))) as kept_sha256 from kept group by doc_id)
select d.doc_id, d.n::bigint as n_bytes, coalesce(k.n, 0)::bigint as n_removed, coalesce(k.c, 0)::bigint as n_spans, kept_sha256
from d join joined using (doc_id) left join (select doc_id, sum(b - a) as n, count(*) as c from runs group by doc_id) k using (doc_id)
"""

ORACLES = {
    "op3_tensored_minhash": _OP3,
    "op6_cover_tree": _OP6,
    "op9_suffix_groups": _OP9,
    "op5_block_top_k": _OP5,
    "op10_url_rules": _OP10,
    "op11_vantage_point": _op11_sql(),
    "op13_stripes": _OP13,
}
