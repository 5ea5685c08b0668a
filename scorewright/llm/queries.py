"""The registered queries of this package, op1 to op13, and the SQL that checks them.

Each applies its operator, with production parameters, to its whole table and derives the digest columns
from what the operator returns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from . import (
    collocations, decontamination, forest_dedup, jaccard_join, language_id, lexical_search, packing, secret_scan, substring_dedup,
    suffix_radix, token_counts, url_filters, warc,
)
from .common import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: (verdict, host, path)
RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_substring_dedup", r"""
with d as (select doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from documents),
n as (select doc_id, coalesce(w, []) as w, len(coalesce(w, [])) as n_words from d),
win as (select doc_id, i, array_to_string(w[i:i + 49], ' ') as t
  from (select doc_id, w, unnest(generate_series(1, n_words - 49)) as i from n where n_words >= 50)),
lowest as (select t, min(doc_id) as lo from win group by t),
bad as (select distinct win.doc_id, i + k as p from win join lowest using (t), range(50) r(k) where lo < win.doc_id),
words as (select doc_id, unnest(generate_series(1, n_words)) as p, unnest(w) as word from n),
kept as (select doc_id, string_agg(word, ' ' order by p) as t, count(*) as n
  from words anti join bad using (doc_id, p) group by doc_id)
select n.doc_id, n_words::bigint as n_words, (n_words - coalesce(kept.n, 0))::bigint as n_removed,
  sha256(coalesce(t, '')) as kept_sha256
from n left join kept using (doc_id)""")
def op1(spark, sf_dir):
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("op2_packing")
def op2(spark, sf_dir):
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op3_language_id")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.filter(F.col("doc_id").isNotNull() & ~language_id.held_out()))
    found = language_id.predict(docs, model)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@query("op4_secret_scan")
def op4(spark, sf_dir):
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secret_scan.written(base), 256).alias("base_sha256"), secret_scan.written(F.col("spans")).alias("spans"),
    )


@query("op5_token_counts")
def op5(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op6_warc", r"""
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as n, sha256(coalesce(html, '')) as h from pages),
f as (select h, min(page_id) as first_id from p where n >= 100 group by h)
select page_id, n::bigint as payload_bytes, h as payload_digest,
  case when first_id < page_id then 'revisit' else 'response' end as record_type,
  case when first_id < page_id then first_id end as refers_to
from p left join f using (h)""")
def op6(spark, sf_dir):
    path = f"{shared_folder(spark)}/scorewright/warc-{uuid.uuid4().hex}"
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    captures = warc.assemble_captures(warc.read_records(spark, path), payload=False)
    captures = captures.select(
        "record_id", "type", "refers_to", "payload_digest", "payload_bytes",
        F.expr("try_cast(regexp_extract(element_at(metadata, 1).fields, 'page_id: (-?[0-9]+)', 1) as bigint)").alias("page_id"),
    )
    captures = stored(captures, "captures")
    originals = captures.filter("type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("original"))
    return captures.join(originals, "refers_to", "left").select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.col("original").alias("refers_to")
    )


@query("op7_decontamination", r"""
with d as (select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w from documents),
b as (select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark where text is not null),
win as (select distinct item_id, least(10, len(w)) as k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as t
  from (select item_id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) as i from b where len(w) > 0)),
sizes as (select distinct k from win),
occ as (select doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') as t
  from (select doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) as i from d, sizes where len(w) >= k)),
hits as (select distinct doc_id, i, win.k, item_id from occ join win on occ.t = win.t and occ.k = win.k),
pos as (select doc_id, count(distinct p) as n from (select doc_id, i + unnest(range(k)) as p from hits) group by doc_id),
items as (select doc_id, count(*) as n, string_agg(s, ',' order by s) as l
  from (select distinct doc_id, item_id::varchar as s from hits) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(pos.n, 0)::bigint as n_hit, coalesce(items.n, 0)::bigint as n_items,
  sha256(coalesce(l, '')) as items_sha256, coalesce(pos.n, 0) > 0 as contaminated
from d left join pos using (doc_id) left join items using (doc_id)""")
def op7(spark, sf_dir):
    found, _ = decontamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op8_jaccard_join", r"""
with recursive w as (select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+'), []) as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + 3], ' ') as g
  from (select doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) as i from w where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as common from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
link as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * common >= 85 * (x.n + y.n - common)),
reach(doc_id, c) as (select doc_id, doc_id from w union select link.b, c from reach join link on link.a = reach.doc_id)
select w.doc_id, coalesce(any_value(n.n), 0)::bigint as n_shingles, min(c)::bigint as component_id
from w join reach using (doc_id) left join n using (doc_id) group by w.doc_id""")
def op8(spark, sf_dir):
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), size=4, percent=85)


@query("op9_forest_dedup", r"""
with recursive v as (select vec_id, embedding::double[] as e from embeddings),
link as (select x.vec_id as a, y.vec_id as b from v x join v y on x.vec_id <> y.vec_id
  and list_cosine_similarity(x.e, y.e) >= 0.95),
reach(vec_id, c) as (select vec_id, vec_id from v union select link.b, c from reach join link on link.a = reach.vec_id)
select vec_id, (select count(*) from link where a = vec_id)::bigint as n_links, min(c)::bigint as component_id,
  vec_id = min(c) as kept
from reach group by vec_id""")
def op9(spark, sf_dir):
    return forest_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op10_url_filters")
def op10(spark, sf_dir):
    judged = url_filters.judge_urls(table(spark, sf_dir, "pages"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op11_suffix_radix", r"""
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
parts as (select doc_id, r, regexp_extract_all(substr(h, (2 * r + 1)::bigint), '.{200}') as t from d, range(100) s(r) where length(h) >= 200),
win as (select doc_id, r + 100 * (j - 1) as s, t[j] as t from (select *, unnest(generate_series(1, len(t))) as j from parts)),
bad as (select doc_id, s from (select doc_id, s, row_number() over (partition by t order by doc_id, s) as k from win) where k > 1),
b as (select doc_id, unnest(generate_series(1, len(w))) - 1 as p, unnest(w) as x from (select doc_id, regexp_extract_all(h, '..') as w from d)),
seen as (select b.doc_id, p, x, max(s) over (partition by b.doc_id order by p) as last from b left join bad on bad.doc_id = b.doc_id and s = p),
gone as (select doc_id, p, x, coalesce(p - last < 100, false) as gone from seen),
runs as (select *, gone and not coalesce(lag(gone) over (partition by doc_id order by p), false) as begins from gone),
sums as (select doc_id, count_if(gone) as n_removed, count_if(begins) as n_spans, string_agg(x, '' order by p) filter (not gone) as kept from runs group by doc_id)
select d.doc_id, (length(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  sha256(unhex(coalesce(kept, ''))) as kept_sha256
from d left join sums using (doc_id)""")
def op11(spark, sf_dir):
    kept = suffix_radix.remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("text", 256).alias("kept_sha256"))


@query("op12_collocations", r"""
with pieces as (select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents where text is not null),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
g as (select lang, k, w[i:i + k - 1] as p from (select lang, w, k, unnest(generate_series(1, len(w) - k + 1)) as i
  from w, range(1, 5) r(k) where len(w) >= k)),
f as (select lang, k, p, count(*) as f from g group by all),
n as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
c as (select * from f where f >= 30),
cuts as (select c.lang, c.k, c.p, c.f as a, i, x.f as l, y.f as r, (2000000::hugeint * c.f) // (x.f + y.f) as score
  from c, range(1, 4) r(i), f x, f y where i < c.k and x.lang = c.lang and x.p = c.p[1:i] and y.lang = c.lang and y.p = c.p[i + 1:c.k]),
least as (select lang, p, any_value(k) as k, any_value(a) as a, min(struct_pack(score := score, i := i, l := l, r := r)) as cut from cuts group by lang, p),
subs as (select lang, p[s:s + m - 1] as p, f from c, range(2, 4) r(m), range(1, 4) q(s) where m < k and s + m - 1 <= k),
covered as (select distinct least.lang, least.p from least join subs on subs.lang = least.lang and subs.p = least.p where 100 * subs.f >= 80 * least.a),
kept as (select lang, array_to_string(p, ' ') as phrase, a, cut.l as l, cut.r as r, cut.score::bigint as score from least anti join covered using (lang, p)),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, n, score from ranked join n using (lang) where rank <= 2000""")
def op12(spark, sf_dir):
    return collocations.mine(table(spark, sf_dir, "documents"))


@query("op13_lexical_search", r"""
with d as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
n as (select doc_id, len(w) as n from d where len(w) > 0),
g as (select count(*) as docs, sum(n)::bigint as total from n),
q as (select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
tf as (select doc_id, term, count(*) as tf from (select doc_id, unnest(w) as term from d) where term in (select term from q) group by all),
w as (select term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint as w from tf, g group by term),
s as (select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total))))::bigint as score
  from tf join w using (term) join n using (doc_id) join q using (term), g group by item_id, doc_id)
select * from (select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::integer as rank, doc_id, score
  from s where score > 0) where rank <= 50""")
def op13(spark, sf_dir):
    return lexical_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
