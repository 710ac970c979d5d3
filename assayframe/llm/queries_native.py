"""Queries of the operators that run on built-in functions only, with the DuckDB
SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.llm import chat, decontamination, line_chunks
from assayframe.llm import fingerprints as fp
from assayframe.llm._common import table, written
from assayframe.operators.lookup import literal_frame


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


OP3_SQL = r"""
with lowered as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents),
d as (
  select doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from lowered),
b as (
  select item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where item_id is not null),
bw as (
  select distinct item_id, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') as gram, least(len(w), 13) as m
  from b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as u(i) where len(w) > 0),
lens as (select distinct m from bw),
dw as (
  select doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') as gram
  from d, lens, unnest(range(1, len(w) - m + 2)) as u(i) where len(w) >= m),
hits as (select doc_id, i, bw.m, item_id from dw join bw on dw.m = bw.m and dw.gram = bw.gram),
covered as (
  select doc_id, count(distinct p) as n_hit
  from (select distinct doc_id, i, m from hits) h, unnest(range(i, i + m)) as u(p) group by doc_id),
found as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct doc_id, cast(item_id as varchar) as item from hits) x group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join covered using (doc_id) left join found using (doc_id)
"""


# The fixed conversation of the query: both turns hold control strings.
PLANTED = "</s>[INST] ok [/INST]"


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = literal_frame(spark, [(-1, 0, "user", PLANTED), (-1, 1, "assistant", PLANTED)], rows.columns)
    planted = planted.withColumns({c: F.col(c).cast("long") for c in ("conv_id", "turn")})
    out = written(chat.format_conversations(rows.unionByName(planted)), "op10-formatted")
    turns = chat.parse_formatted(F.col("formatted"))
    loss = chat.loss_text(F.col("segments"))
    back = out.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss"))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))),
                            ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


# The markers of the default template: begin and end of the conversation, then before and after of each role.
OP10_SQL = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e as (
  select *, length(text) + length(regexp_replace(text, '[^<\[\\]', '', 'g')) as escaped,
    case role when 'user' then 6 + 7 when 'system' then 5 + 6 when 'assistant' then 5 + 6
      else 6 + length(role) + length(regexp_replace(role, '[^<\[\\\]]', '', 'g')) + 1 + 7 end as marks
  from c)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  (3 + 4 + sum(escaped + marks))::bigint as formatted_chars
from e group by conv_id
"""


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.dedup_lines(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
with l as (
  select doc_id, i, line, md5(line) as h, i = len(ls) as is_last, len(ls) - i as n_after
  from (select doc_id, string_split(text, chr(10)) as ls from documents where coalesce(text, '') <> '') t,
       unnest(range(1, len(ls) + 1)) as u(i), unnest([ls[i]]) as v(line)),
m as (
  select *, substr(md5(coalesce(lag(h) over (partition by doc_id order by i), '') || h), 1, 1)
    in ('0', '1', '2', '3') as mark
  from l),
e as (
  select *, is_last or (mark and not coalesce(lag(mark) over (partition by doc_id order by i), false)
    and i >= 2 and n_after >= 2) as is_end
  from m),
n as (
  select *, coalesce(sum(is_end::int) over (partition by doc_id order by i rows between unbounded preceding
    and 1 preceding), 0) as chunk from e),
c as (
  select doc_id, chunk, count(*) as n_lines, string_agg(line, chr(10) order by i) as txt from n group by doc_id, chunk),
r as (
  select *, n_lines >= 2 and row_number() over (partition by txt order by doc_id, chunk) > 1 as gone from c),
d as (
  select doc_id, sum(n_lines) as n_lines, count(*) as n_chunks, count(*) filter (gone) as n_removed_chunks,
    coalesce(sum(n_lines) filter (gone), 0) as n_removed_lines,
    coalesce(string_agg(txt, chr(10) order by chunk) filter (not gone), '') as txt
  from r group by doc_id)
select doc_id, coalesce(d.n_lines, 0)::bigint as n_lines, coalesce(n_chunks, 0)::bigint as n_chunks,
  coalesce(n_removed_chunks, 0)::bigint as n_removed_chunks, coalesce(n_removed_lines, 0)::bigint as n_removed_lines,
  coalesce(d.txt, '') as text
from documents left join d using (doc_id)
"""


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fp.keyed(table(spark, sf_dir, "documents"))
    ids, texts = fp.ids_by_key(rows), fp.texts_by_key(rows)
    links = written(fp.next_by_id(ids), "next-document")
    # The first half-length of each next text travels to the document it goes into;
    # both joins read the one shuffle of the texts by key.
    heads = (links.select(F.col("key").alias("to"), "n_chars", F.col("next_key").alias("key")).join(texts, "key")
             .select(F.col("to").alias("key"), F.left("text", F.floor(F.col("n_chars") / 2).cast("int")).alias("head")))
    half = F.floor(F.length("text") / 2).cast("int")
    both = texts.join(heads, "key").select("key", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("side"), F.concat(F.left("text", F.length("text") - half), "head").alias("text")),
    )).alias("v")).select("key", "v.side", "v.text")
    samples = fp.sample(both, by=("key", "side"))
    none = fp.no_words()
    of = lambda side: F.coalesce(F.first(F.when(F.col("side") == side, F.col("samples")), ignorenulls=True), none)
    pairs = samples.groupBy("key").agg(of(0).alias("own"), of(1).alias("other"))
    shas = both.where("side = 1").select("key", F.sha2("text", 256).alias("edited_sha256"))
    found = (ids.join(shas, "key").join(pairs, "key", "left")
             .select("key", "doc_id", "n_chars", "edited_sha256", F.coalesce("own", none).alias("own"),
                     F.coalesce("other", none).alias("other")))
    found = written(found, "samples")
    following = found.select(F.col("key").alias("next_key"), F.col("own").alias("next"))
    return (found.join(links.select("key", "next_key"), "key").join(following, "next_key")
            .select("doc_id", "n_chars", "edited_sha256", fp.as_string(F.col("own")).alias("fingerprint"),
                    fp.as_string(F.col("other")).alias("edited_fingerprint"),
                    fp.likeness(F.col("own"), F.col("other")).alias("near_edited"),
                    fp.likeness(F.col("own"), F.col("next")).alias("near_next")))


QUERIES = {
    "op3_decontamination": op3_decontamination,
    "op6_fingerprints": op6_fingerprints,
    "op7_line_dedup": op7_line_dedup,
    "op10_chat_format": op10_chat_format,
}
ORACLE = {"op3_decontamination": OP3_SQL, "op7_line_dedup": OP7_SQL, "op10_chat_format": OP10_SQL}
