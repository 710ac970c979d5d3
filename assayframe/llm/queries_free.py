"""Queries of the operators that run numpy inside tasks. Those without SQL are tested
against brute-force versions and exact round trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.llm import kneser_ney, maxent_lm, mixing, near_dup, phrases, spelling, suffix_dedup, token_counts, token_files
from assayframe.llm._common import ship_package, table
from assayframe.session import scratch_path


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return suffix_dedup.dedup_bytes(table(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return maxent_lm.score(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    found = kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "lang", "n_bytes", "log_perplexity", "threshold", "keep")


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    path = scratch_path(spark, "token-shards")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path)
    back = token_files.read_token_files(spark, path)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return phrases.collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
total as (select lang, sum(len(w))::bigint as n from w group by lang),
grams as (
  select lang, k::bigint as k, array_to_string(w[i:i + k - 1], ' ') as phrase
  from w, unnest([1, 2, 3]) as ks(k), unnest(range(1, len(w) - k + 2)) as u(i)),
f as (select lang, phrase, k, count(*)::bigint as c from grams group by all having count(*) >= 10),
cuts as (
  select lang, phrase, c as a, cut, array_to_string(string_split(phrase, ' ')[1:cut], ' ') as head,
    array_to_string(string_split(phrase, ' ')[cut + 1:k], ' ') as rest
  from f, unnest(range(1, k)) as u(cut) where k > 1),
scored as (
  select c.lang, c.phrase, c.a, c.cut, h.c as l, t.c as r,
    ((1000000::hugeint * c.a::hugeint * c.a::hugeint) // (h.c::hugeint * t.c::hugeint))::bigint as score
  from cuts c join f h on h.lang = c.lang and h.phrase = c.head join f t on t.lang = c.lang and t.phrase = c.rest),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
inner_ as (
  select lang, array_to_string(string_split(phrase, ' ')[i:i + 1], ' ') as phrase, max(c) as longer
  from f, unnest([1, 2]) as u(i) where k = 3 group by all),
kept as (select l.* from lowest l left join inner_ i using (lang, phrase) where longer is null or 100 * longer < 50 * a),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase)::bigint as rank from kept)
select lang, rank, phrase, a, l, r, n, score from ranked join total using (lang) where rank <= 2000
"""


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


# The crc32 runs over the bits of each byte, least bit first.
OP13_SQL = r"""
with recursive runs as (
  select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as c
  from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]{5,}')) as run from documents) t
  group by all),
coded as (select *, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as hx from runs),
hashed as (
  select run, c, xor(4294967295, list_reduce(
      list_prepend(4294967295::bigint, flatten(list_transform(range(1, length(hx), 2), lambda i: list_transform(range(0, 8), lambda k:
        (((instr('0123456789ABCDEF', substr(hx, i, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(hx, i + 1, 1)) - 1) >> k) & 1)))),
      lambda crc, b: xor(crc >> 1, (xor(crc, b) & 1) * 3988292384))) as h
  from coded),
words as (
  select word, sum(c)::bigint as n
  from (select case when h % 97 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2)
               else run end as word, c from hashed) t
  where length(word) >= 5 group by word having sum(c) >= 3),
cuts as (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
         from words, unnest(range(1, length(word) + 1)) as u(i)),
near as (
  select a.word, b.word as other, b.n as other_n from cuts a join cuts b
    on a.rest = b.rest and a.i = b.i and length(a.word) = length(b.word) and a.word <> b.word
  union select a.word, b.word, b.n from words a join cuts b on a.word = b.rest
  union select b.word, a.word, a.n from words a join cuts b on a.word = b.rest),
counted as (select word, count(*) as n_near, max(other_n) as most from near group by word),
best as (select n.word, min(n.other) as other, c.most from near n join counted c on n.word = c.word and n.other_n = c.most
         group by n.word, c.most),
formed as (
  select w.word, w.n, coalesce(c.n_near, 0)::bigint as n_near, case when b.most >= 2 * w.n then b.other end as form,
    case when b.most >= 2 * w.n then b.most end as form_n
  from words w left join counted c using (word) left join best b using (word)),
chain as (
  select word, word as at_word from formed
  union all select c.word, f.form from chain c join formed f on c.at_word = f.word where f.form is not null)
select f.word, f.form, c.at_word as root, f.n, f.n_near, f.form_n
from formed f join chain c using (word) join formed g on c.at_word = g.word where g.form is null
"""


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_quality": op5_quality,
    "op8_token_output": op8_token_output,
    "op9_near_dup": op9_near_dup,
    "op11_token_counts": op11_token_counts,
    "op12_phrases": op12_phrases,
    "op13_spelling": op13_spelling,
}
ORACLE = {"op12_phrases": OP12_SQL, "op13_spelling": OP13_SQL}
