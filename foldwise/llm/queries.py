"""Queries that apply the operators to the sample tables, and their SQL where SQL can express them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from foldwise.llm import (
    bpe, codes, decontaminate, filter_audit, langid, licenses, pieces, quality, simhash, substrings, token_counts, vafile, warc,
)
from foldwise.llm.shared import table, work_folder

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    """Register a query and, if given, its SQL."""
    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return keep


@query("op3_simhash_near_dedup")
def op3_simhash_near_dedup(spark, folder):
    groups = simhash.near_duplicate_groups(table(spark, folder, "documents"), "doc_id", "text", shingle=4, distance=4)
    return groups.select("doc_id", simhash.hex_text(F.col("fingerprint")).alias("fingerprint"), "component_id")


@query("op8_substring_dedup", r"""
with docs as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') as words
  from documents),
spans as (
  select doc_id, unnest(range(1, len(words) - 18)) as s, words from docs where len(words) >= 20),
windows as (
  select doc_id, s, array_to_string(words[s:s + 19], ' ') as w from spans),
repeats as (
  select doc_id, s from (
    select doc_id, s, row_number() over (partition by w order by doc_id, s) as n from windows) where n > 1),
gone as (
  select distinct doc_id, s + unnest(range(0, 20)) as i from repeats),
lists as (
  select doc_id, list(i) as removed from gone group by doc_id)
select d.doc_id, cast(len(d.words) as bigint) as n_words, cast(coalesce(len(l.removed), 0) as bigint) as n_removed,
       sha256(array_to_string(list_filter(d.words, lambda w, i: not coalesce(list_contains(l.removed, i), false)), ' '))
         as kept_sha256
from docs d left join lists l using (doc_id)""")
def op8_substring_dedup(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    left = substrings.drop_repeats(docs, "doc_id", "text", min_words=20, outputs=["n_words", "n_removed", "kept_sha256"])
    return left.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op9_exact_top_k", """
with v as (
  select vec_id, [floor(64 * x::double) for x in embedding] as e from embeddings
  where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
scores as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
  from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scores)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 20""")
def op9_exact_top_k(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return vafile.top_k_inner_product(vectors, F.col("vec_id") % 20 == 0, k=20, key="vec_id", vector="embedding", scale=64)


@query("op5_warc", """
with p as (
  select page_id, coalesce(html, '') as body from pages),
d as (
  select page_id, cast(strlen(body) as bigint) as payload_bytes, sha1(body) as payload_digest from p),
o as (
  select payload_digest, max(page_id) as owner from d where payload_bytes >= 1000 group by 1)
select d.page_id, d.payload_bytes, d.payload_digest,
       case when d.page_id < o.owner then 'revisit' else 'response' end as record_type,
       case when d.page_id < o.owner then o.owner end as refers_to
from d left join o using (payload_digest)""")
def op5_warc(spark, folder):
    pages = table(spark, folder, "pages")
    files = warc.write_warc(pages, f"{work_folder(spark)}/warc-{uuid.uuid4().hex}", "page_id", "url", "html")
    records = warc.resolved(warc.read_warc(files, payload=False))
    number = lambda c: F.regexp_extract(c, "urn:page:(-?[0-9]+)$", 1).try_cast("bigint")
    return records.select(number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
                          F.col("type").alias("record_type"), number(F.col("refers_to")).alias("refers_to"))


_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce({0}, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"""


@query("op6_decontamination", f"""
with docs as (
  select doc_id, {_WORDS.format('text')} as words from documents),
items as (
  select item_id, words, least(10, len(words)) as n from (
    select item_id, {_WORDS.format('text')} as words from benchmark) where len(words) > 0),
starts as (
  select item_id, n, words, unnest(range(1, len(words) - n + 2)) as s from items),
windows as (
  select distinct item_id, n, array_to_string(words[s:s + n - 1], ' ') as w from starts),
places as (
  select d.doc_id, l.n, d.words, unnest(range(1, len(d.words) - l.n + 2)) as s
  from docs d, (select distinct n from items) l where len(d.words) >= l.n),
hits as (
  select p.doc_id, p.s, p.n, w.item_id from places p join windows w
  on p.n = w.n and array_to_string(p.words[p.s:p.s + p.n - 1], ' ') = w.w),
hit_words as (
  select doc_id, count(distinct i) as n_hit from (select doc_id, s + unnest(range(0, n)) as i from hits) group by 1),
hit_items as (
  select doc_id, count(*) as n_items, string_agg(i, ',' order by i) as ids from (
    select distinct doc_id, cast(item_id as varchar) as i from hits) group by 1)
select d.doc_id, cast(len(d.words) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from docs d left join hit_words using (doc_id) left join hit_items using (doc_id)""")
def op6_decontamination(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, folder, "benchmark"), n=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query("op1_language_id")
def op1_language_id(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    model = langid.fit_language_model(docs, "text", "lang", "doc_id", usable=~held_out)
    found = langid.identify(docs.select("doc_id", "text"), model, "text")
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "accepted")


@query("op2_quality")
def op2_quality(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit_quality_model(docs, "text", "doc_id")
    return quality.classify(docs, model, "text").select("doc_id", "posterior", "score", "keep")


@query("op4_sentencepiece")
def op4_sentencepiece(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pieces.encode(docs, "text").select("doc_id", "token_ids", "n_tokens", "round_trip", "parity")


@query("op7_token_counts")
def op7_token_counts(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, "text").select("doc_id", "n_tokens")


_TEMPLATES = ", ".join(f"('{name}', '{body}')" for name, body in licenses.TEMPLATES)


@query("op10_license_scan", f"""
with files as (
  select doc_id, source || '/' || lang || '/' || doc_id as path, source || '/' || lang as dir, source as top, text,
         regexp_matches(lower(split_part(coalesce(text, ''), chr(10), 1)), 'licen[sc]|rights reserved') as is_file
  from documents),
templates(licence, body) as (values {_TEMPLATES}),
template_words as (
  select licence, word, count(*) as n from (
    select licence, unnest(regexp_extract_all(lower(body), '[a-z0-9]+')) as word from templates) group by all),
size as (select count(*) as n from files),
idf as (
  select t.word, ln((1 + (select n from size)) / (1 + count(d.path))) + 1 as idf
  from (select distinct word from template_words) t left join (
    select distinct path, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) as word from files) d using (word)
  group by t.word),
lines as (
  select path, is_file, unnest(string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10))) as unit,
         generate_subscripts(string_split(text, chr(10)), 1) as i from files
  union all select path, is_file, text, 0 from files where is_file),
vectors as (
  select path, i, word, count(*) as n from (
    select path, i, unnest(regexp_extract_all(lower(unit), '[a-z0-9]+')) as word from lines) group by all),
weighted as (
  select path, i, word, n * coalesce(idf, ln((1 + (select n from size)) / 2) + 1) as x from vectors left join idf using (word)),
lengths as (select path, i, sqrt(sum(x * x)) as length from weighted group by all),
template_weights as (select licence, word, n * idf as x from template_words join idf using (word)),
template_lengths as (select licence, sqrt(sum(x * x)) as length from template_weights group by all),
scores as (
  select w.path, t.licence, round(sum(w.x * t.x) / (any_value(l.length) * any_value(tl.length)), 6) as score
  from weighted w join template_weights t using (word) join lengths l on l.path = w.path and l.i = w.i
  join template_lengths tl on tl.licence = t.licence group by w.path, w.i, t.licence),
own as (
  select path, licence, score from (
    select *, row_number() over (partition by path order by score desc, licence) as n from scores where score >= 0.8)
  where n = 1),
dirs as (
  select dir, licence, score from (
    select f.dir, o.*, row_number() over (partition by f.dir order by o.score desc, o.path) as n
    from files f join own o using (path) where f.is_file) where n = 1)
select f.doc_id, coalesce(o.licence, d.licence) as licence,
       case when o.licence is not null then o.score else d.score end as licence_score,
       case when o.licence is not null then 'own' when d.licence is not null then 'inherited' end as licence_origin,
       case when o.licence is null then d.dir end as licence_dir
from files f left join own o using (path)
left join dirs d on d.dir = f.dir and d.licence is not null""")
def op10_license_scan(spark, folder):
    """Documents as files <source>/<lang>/<doc_id>; one that opens with a licence line is its directory's licence file."""
    docs = table(spark, folder, "documents")
    files = docs.select("doc_id", F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")),
                                              F.col("doc_id").cast("string")).alias("path"), "text")
    opens = F.lower(F.substring_index("text", "\n", 1)).rlike("licen[sc]|rights reserved")
    found = licenses.scan_licences(files, "path", "text", licence_file=opens)
    return found.select("doc_id", "licence", "licence_score", "licence_origin", "licence_dir")


@query("op11_filter_audit", r"""
with docs as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') as words
  from documents),
fails as (
  select doc_id, part,
         case when len(words) < 100 then 1 else 0 end
         + case when 100 * len(list_distinct(words)) < 80 * len(words) then 2 else 0 end
         + case when 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * len(t) then 4 else 0 end
         + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end
         + case when doc_id > min(doc_id) over (partition by t) then 16 else 0 end as mask
  from docs),
known as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels group by doc_id),
counts as (
  select part, mask, count(*) as n, coalesce(sum(good), 0) as good, coalesce(sum(toxic), 0) as toxic
  from fails left join known using (doc_id) group by part, mask),
f(letter, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders as (
  select [a.letter, b.letter, c.letter, d.letter, e.letter] as letters, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from f a, f b, f c, f d, f e
  where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
steps as (
  select array_to_string(letters, '') as filter_order, step, bits[step] as bit,
         coalesce(list_sum(bits[1:step - 1]), 0)::bigint as before
  from orders, range(1, 6) as r(step)),
audit as (
  select part, filter_order, step, bit,
         sum(case when mask & (before | bit) = 0 then n else 0 end) as kept,
         sum(case when mask & before = 0 and mask & bit <> 0 then n else 0 end) as removed,
         sum(case when mask & before <> 0 and mask & bit <> 0 then n else 0 end) as redundant,
         sum(case when mask = bit then n else 0 end) as unique_fails,
         sum(case when mask & before = 0 and mask & bit <> 0 then good else 0 end) as good_lost,
         sum(case when mask & before = 0 and mask & bit <> 0 then toxic else 0 end) as toxic_lost
  from counts, steps group by all)
select part, filter_order, step::integer as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
       unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
       (sum(removed) over (partition by part, bit))::bigint as shapley
from audit""")
def op11_filter_audit(spark, folder):
    return filter_audit.audit_filters(
        table(spark, folder, "documents"), filter_audit.default_filters("text"), "E", "doc_id", "text", part="lang",
        labels=table(spark, folder, "labels"), lost={"good_lost": F.col("quality") == 1, "toxic_lost": F.col("toxic") == 1})


def _codebook_rounds(rounds: int) -> str:
    """SQL: assignments to the codebook of a round, and the codebook that they give."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
gaps{i} as materialized (
  select p.vec_id, p.part, b.entry, list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as gap
  from parts p join book{i} b using (part)),
near{i} as materialized (
  select vec_id, part, entry, gap from (
    select *, row_number() over (partition by vec_id, part order by gap, entry) as r from gaps{i}) where r = 1)""")
        if i < rounds:
            steps.append(f"""
means{i} as (
  select n.part, n.entry, d.place, floor(sum(p.v[d.place])::double / count(*))::bigint as x
  from near{i} n join parts p using (vec_id, part), (select unnest(range(1, (select max(len(v)) from parts) + 1)) as place) d
  group by all),
book{i + 1} as materialized (
  select b.part, b.entry, coalesce(m.v, b.v) as v from book{i} b left join (
    select part, entry, list(x order by place) as v from means{i} group by part, entry) m using (part, entry))""")
    return ",".join(steps)


@query("op12_vector_codes", f"""
with kept as (
  select vec_id, label, [floor(256 * x::double)::bigint for x in embedding] as v from embeddings
  where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
parts as materialized (
  select vec_id, part, v[part * w + 1:(part + 1) * w] as v from (select *, len(v) // 16 as w from kept), range(16) as r(part)),
book0 as materialized (
  select part, f.entry, v from parts join (
    select vec_id, row_number() over (order by vec_id) - 1 as entry from kept order by vec_id limit 64) f using (vec_id)),
{_codebook_rounds(2)},
coded as (
  select vec_id, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' order by part) as code, sum(gap)::bigint as error
  from near2 group by vec_id)
select c.vec_id, c.code, c.error, (sum(c.error) over (partition by k.label))::bigint as label_error,
       (select sha256(string_agg(x::varchar, ',' order by part, entry, place)) from (
          select part, entry, unnest(v) as x, generate_subscripts(v, 1) as place from book2)) as codebooks_sha256
from coded c join kept k using (vec_id)""")
def op12_vector_codes(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    books = codes.fit_codebooks(vectors, "vec_id", "embedding", parts=16, entries=64, rounds=2, scale=256)
    coded = codes.encode_vectors(vectors, books, "embedding").drop("embedding")
    return codes.label_errors(coded, "label").select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))


@query("op13_bpe")
def op13_bpe(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    coded = bpe.encode(docs, "text", decoded="decoded")
    return coded.select(
        "doc_id", "n_tokens", F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
