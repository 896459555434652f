"""The registered queries of this package, and SQL for those that it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bpe_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aeroskein.llm.site_style_tree import extract_main_text

    return extract_main_text(table(spark, sf_dir, "pages"))


def op2_fair_queue_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aeroskein.llm.mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aeroskein.llm.embedding_dedup import embedding_links

    return embedding_links(table(spark, sf_dir, "embeddings"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aeroskein.llm.sentencepiece_bpe import encode_texts

    return encode_texts(table(spark, sf_dir, "documents"), bpe_model(), ids=False)


def op5_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aeroskein.llm.toxicity import toxicity_scores

    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aeroskein.llm.line_dedup import apply_bitmaps, keep_bitmaps

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = apply_bitmaps(docs, keep_bitmaps(docs, min_docs=10, min_chars=1))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aeroskein.llm.bagminhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_knn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aeroskein.llm.knn_quality import quality_scores

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aeroskein.llm.arc_warc import archive_round_trip

    return archive_round_trip(table(spark, sf_dir, "pages"))


def op10_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aeroskein.llm.divergence import language_references, quality_rules

    docs = table(spark, sf_dir, "documents")
    return quality_rules(docs, language_references(docs))


def op11_centroid_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aeroskein.llm.centroids import clustered_vectors

    return clustered_vectors(table(spark, sf_dir, "embeddings"))


def op12_skip_chain_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aeroskein.llm.personal_data import find_personal_data, learn, span_columns

    docs = table(spark, sf_dir, "documents")
    return span_columns(find_personal_data(docs, learn(docs)))


def op13_lightest_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aeroskein.llm.conversations import repair_conversations

    return repair_conversations(table(spark, sf_dir, "conversations"))


QUERIES = {k: f for k, f in list(globals().items()) if k.startswith("op") and callable(f)}


def _lloyd(rounds: int) -> str:
    """Lloyd rounds as one chain of CTEs: every vector against every centroid in each of them."""
    sql = """
with v as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as x from embeddings
  where len(embedding) = 64 and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))),
c0 as (select row_number() over (order by h, x) - 1 as c, x from (select x, sha256('1:' || coalesce(cast(vec_id as varchar), '')) as h from v order by h, x limit 16))"""
    for i in range(rounds + 1):
        sql += f""",
a{i} as (
  select r, min_by(c, (d, c)) as c, min(d) as d from (
    select r, c, cast(list_sum(list_transform(list_zip(v.x, k.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as bigint) as d from v cross join c{i} k) group by r),
s{i} as (
  select c, list(m order by i) as x from (
    select c, i, cast((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) as bigint) as m
    from (select c, unnest(range(64)) as i, unnest(x) as x from a{i} join v using (r)) group by c, i) group by c),
c{i + 1} as (select c, coalesce(s.x, k.x) as x from c{i} k left join s{i} s using (c))"""
    return sql + f"""
select vec_id, cast(c as integer) as cluster, d as distance, cast(sum(d) over (partition by c) as bigint) as cluster_inertia, cast(sum(d) over () as bigint) as inertia,
  sha256(array_to_string(k.x, ',')) as centroid_sha256
from v join a{rounds} using (r) join c{rounds} k using (c)"""


def _cheapest_edits() -> str:
    """The cheapest edits row by row: for each of four states the least (cost, edits, rows), with inserts before each row."""

    def plus(v: str, cost: str, edit: str, line: str = "") -> str:
        rows = f"list_append({v}.t, {line})" if line else f"{v}.t"
        return f"case when {v} is not null then {{'c': {v}.c + {cost}, 'a': {v}.a || '{edit}', 't': {rows}}} end"

    def least(*values: str) -> str:
        return f"list_min([{', '.join(values)}])"

    def insert(v: str, role: str) -> str:
        return plus(v, "3", "I", f"'{role}:'")

    inserted = f"""u1 as (select *, {least("u", insert("n", "user"), insert("s", "user"), insert("a", "user"))} as u2 from %s)"""
    both = f"""u3 as (select *, {least("a", insert("u2", "assistant"))} as a2 from u1)"""

    def keep(v: str, initial: str) -> str:
        return f"case when r.role[1] = '{initial}' then {plus(v, 'stay', 'K', 'line')} end"

    def read(state: str, *kept: str) -> str:
        return f"case when gone then {plus(state, '4', 'D')} else {least(plus(state, '4', 'D'), *kept)} end"

    user = [x for v in ("n", "s", "a2") for x in (keep(v, "u"), plus(v, "3 + stay", "R", "'user:' || r.text"))]
    assistant = [keep("u2", "a"), plus("u2", "3 + stay", "R", "'assistant:' || r.text")]
    value = "struct(c bigint, a varchar, t varchar[])"
    return rf"""
with recursive keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''), lambda x: cast(ascii(x) as bigint))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 as code
  from conversations),
damaged as (
  select conv_id, turn, case when code = 4 then 'user' else role end as role, case code when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
    unnest(case code when 0 then [] when 3 then [1, 2] else [1] end) as copy from keyed),
ordered as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as bare from damaged),
judged as (
  select *, bare = '' as blank, bare <> '' and row_number() over (partition by conv_id, role, text order by i) > 1 as duplicate,
    lag(role[1]) over (partition by conv_id order by i) || role[1] not in ('su', 'ua', 'au') as illegal from ordered),
r as (select *, blank or duplicate as gone, not blank and not duplicate and right(bare, 1) not in ('.', '!', '?') as truncated, case when truncated then 3 else 0 end as stay, role || ':' || text as line from judged),
counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where blank) as blank, count(*) filter (where duplicate) as duplicate,
    count(*) filter (where truncated) as truncated, count(*) filter (where illegal) as illegal, max(i) as rows from r group by conv_id),
dp as (
  select conv_id, 0::bigint as i, {{'c': 0, 'a': '', 't': []}}::{value} as n, null::{value} as s, null::{value} as u, null::{value} as a from (select distinct conv_id from keyed)
  union all
  select conv_id, i, {read("n")}, {read("s", keep("n", "s"))}, {read("u2", *user)}, {read("a2", *assistant)}
  from (
    with {inserted % "dp"}, {both}
    select r.conv_id, r.i, n, s, u2, a2, gone, stay, line, r.role, r.text from u3 join r on r.conv_id is not distinct from u3.conv_id and r.i = u3.i + 1) as r),
{inserted % "dp"}, {both},
ends as (select u3.conv_id, {least("n", "a2")} as best, c.* exclude (conv_id) from u3 left join counted c on c.conv_id is not distinct from u3.conv_id where u3.i = coalesce(c.rows, 0))
select conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
  best.c as cost, best.a as audit, sha256(array_to_string(best.t, chr(10))) as repaired_sha256 from ends"""


_WORDS = r"'[^\x20\x09-\x0D]+'"

ORACLES = {
    "op2_fair_queue_mix": rf"""
with sized as (
  select doc_id, case when source is null then '1' else '0' || source end as skey,
    md5('mix:' || coalesce(cast(doc_id as varchar), '')) as ord,
    cast(len(regexp_extract_all(coalesce(text, ''), {_WORDS})) as bigint) as size
  from documents),
sources as (
  select *, (rank - 1) % 3 + 1.0::double as weight, source_size * 3.0::double as cap
  from (select skey, cast(sum(size) as bigint) as source_size, row_number() over (order by skey) as rank from sized group by skey)),
levels as (
  select *, row_number() over o as place, sum(source_size) over () * 1.0::double as total,
    (sum(source_size) over () * 1.0::double - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0.0))
      / sum(weight) over (o rows between current row and unbounded following) as level
  from sources window o as (order by cap / weight, rank)),
shares as (
  select skey, rank, source_size, case when final is null then cap else least(cap, final * weight) end as target
  from (select *, min_by(level, place) filter (where cap > level * weight) over () as final from levels)),
queued as (
  select doc_id, size, rank, source_size, target, sum(size) over (partition by sized.skey order by ord, doc_id, size rows unbounded preceding) as ends, ord
  from sized join shares using (skey)),
copies as (
  select *, (source_size * copy + ends)::double / target as vt
  from queued cross join (values (0), (1), (2)) c(copy) where size > 0 and target > 0),
cut as (
  select doc_id, ord, ends, rank, size, sum(size) over (order by vt, rank, copy rows unbounded preceding) <= (select sum(target) from shares) as fits from copies),
taken as (select doc_id, ord, ends, rank, sum(size) filter (where fits) as taken from cut group by all)
select q.doc_id, q.size, q.source_size, q.target, cast(case when q.size = 0 then 0 else coalesce(t.taken, 0) end as bigint) as taken
from queued q left join taken t on q.doc_id is not distinct from t.doc_id and q.ord = t.ord and q.ends = t.ends and q.rank = t.rank
""",
    "op3_embedding_dedup": r"""
with recursive v as (
  select vec_id, cast(embedding as double[]) as e from embeddings
  where len(embedding) > 0 and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))) and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
link as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.95),
reach as (select vec_id as a, vec_id as b from embeddings union select r.a, l.b from reach r join link l on r.b = l.a),
component as (select a, min(b) as c from reach group by a), degree as (select a, count(*) as n from link group by a)
select vec_id, coalesce(n, 0) as n_links, c as component_id, vec_id = c as kept from embeddings e join component on component.a = e.vec_id left join degree on degree.a = e.vec_id
""",
    "op7_bagminhash": rf"""
with recursive words as (select doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) as w from documents where doc_id is not null),
grams as (
  select doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as g from words),
bag as (select doc_id, g, count(*) as n from grams group by all), size as (select doc_id, sum(n) as t from bag group by doc_id),
shared as (select a.doc_id as a, b.doc_id as b, sum(least(a.n, b.n)) as m from bag a join bag b using (g) where a.doc_id < b.doc_id group by all),
pairs as (select a, b from shared join size x on x.doc_id = a join size y on y.doc_id = b where m >= 0.8 * (x.t + y.t - m)),
link as (select a, b from pairs union all select b, a from pairs),
reach as (select doc_id as a, doc_id as b from words union select r.a, l.b from reach r join link l on r.b = l.a),
component as (select a, min(b) as c from reach group by a)
select doc_id, c as class_id, doc_id = c as kept, case when len(w) > 0 then min(doc_id) over (partition by w) else doc_id end as copy_of from words join component on component.a = words.doc_id
""",
    "op9_arc_to_warc": r"""
with hashed as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as h from pages),
digits as (
  select *, list_transform(range(40), lambda i: strpos('0123456789abcdef', substr(h, i + 1, 1)) - 1) as d from hashed),
coded as (
  select page_id, payload_bytes, max(page_id) over (partition by h) as top,
    array_to_string(list_transform(range(32), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(((d[i * 5 // 4 + 1] * 16 + d[i * 5 // 4 + 2]) >> (3 - i * 5 % 4)) & 31 as bigint) + 1, 1)), '') as payload_digest
  from digits)
select page_id, payload_bytes, payload_digest, case when page_id = top then 'response' else 'revisit' end as record_type, case when page_id <> top then top end as refers_to from coded
""",
    "op11_centroid_products": _lloyd(3),
    "op13_lightest_repair": _cheapest_edits(),
    "op6_line_dedup": r"""
with docs as (select doc_id, md5(coalesce(text, '')) as k, string_split(coalesce(text, ''), chr(10)) as lines from documents),
line as (
  select doc_id, k, unnest(range(len(lines))) as pos, unnest(lines) as line from docs),
keyed as (
  select *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as key from line),
often as (select key from keyed where length(key) >= 1 group by key having count(distinct doc_id) >= 10)
select doc_id, cast(count(*) as bigint) as n_lines, cast(count(often.key) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where often.key is null), '')) as kept_sha256
from keyed left join often using (key) group by doc_id, k
""",
}
