"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    conversations, cover_tree, embedding_dedup, hnsw, licenses, mixing, phrases, pieces, quality, simhash, toxicity, url_filter, warc)
from tidemark.llm.common import word_count
from tidemark.session import settle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

TOKENIZER = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_bytes(name: str = TOKENIZER) -> bytes:
    """The public vocabulary file; its place is the installed package's business."""
    import public_tokenizers
    return pieces.read_model(public_tokenizers.path(name))


@_query
def op1_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    # the mix reads its rows several times: the texts are counted once
    docs = settle(_table(spark, sf, "documents").select(
        "doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    mixed = mixing.mix(docs, "size")
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).cast("long").alias("taken"))


SQL["op1_source_mix"] = r"""
with docs as (
  select doc_id, source,
    cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
    from documents),
keyed as (select *, md5(coalesce(cast(doc_id as varchar), '') || '|' || cast(size as varchar))
          as k from docs),
sources as (
  select source, cast(sum(size) as hugeint) as source_size, count(*) as n,
    [1, 2, 3][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight,
    row_number() over (order by source nulls last) as turn
  from docs group by source),
filled as (
  select *, 3 * source_size as cap,
    sum(3 * source_size) over w as caps, sum(weight) over w as weights,
    sum(weight) over () as all_weights, sum(source_size) over () as total
  from sources
  window w as (order by cast(3 * source_size as double) / weight, turn
               rows between unbounded preceding and current row)),
decided as (
  select *, caps * weight + cap * (all_weights - weights) <= total * weight as is_full
  from filled),
level as (
  select coalesce(sum(case when is_full then cap end), 0) as given,
    sum(case when not is_full then weight end) as open_weight from decided),
plan as (
  select source, source_size, n,
    case when is_full then cast(cap as double)
      else cast(total - given as double) * weight / open_weight end as target,
    cast(ceil(n / 4000.0) as bigint) as buckets,
    md5('11:' || coalesce(source, chr(0) || 'null')) as digits
  from decided, level),
placed as (
  select d.doc_id, d.size, p.source, p.source_size, p.target, p.digits,
    case when p.source_size > 0 then p.target / cast(p.source_size as double) else 1.0 end as rate,
    cast(row_number() over (partition by p.source
      order by cast('0x' || substr(k, 1, 8) as bigint) % p.buckets, size, k) as double) as place
  from keyed d join plan p on d.source is not distinct from p.source),
tried as (
  select *, cast((floor(start_at + place * rate) - floor(start_at + (place - 1.0) * rate))
                 as bigint) * size as taken
  from (select *, cast(cast('0x' || substr(digits, 1, 5) as bigint) as double) / 1048576.0
          + i / 16.0 as start_at
        from placed, range(16) t(i))),
nearest as (
  select source, i, row_number() over (partition by source
    order by abs(sum(taken) - target), i) as turn
  from tried group by source, target, i)
select t.doc_id, t.size, cast(t.source_size as bigint) as source_size, t.target, t.taken
from tried t join nearest n on n.source is not distinct from t.source and n.i = t.i
where n.turn = 1"""


@_query
def op2_cover_tree(spark: SparkSession, sf: str) -> DataFrame:
    return cover_tree.top_products(_table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, 20)


SQL["op2_cover_tree"] = """
with usable as (
  select vec_id, [cast(floor(64 * cast(x as double)) as bigint) for x in embedding] as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id,
    cast(list_sum([q.v[i] * c.v[i] for i in range(1, len(q.v) + 1)]) as bigint) as score
  from usable q join usable c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id),
ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id)
                 as integer) as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20"""


@_query
def op3_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf, "documents"))
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


@_query
def op4_hnsw(spark: SparkSession, sf: str) -> DataFrame:
    return hnsw.nearest(_table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, 10)


@_query
def op5_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


@_query
def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


@_query
def op7_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.best_licenses(_table(spark, sf, "documents"))


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


SQL["op7_license_scan"] = rf"""
with templates(license, body) as (values
  {", ".join(f"({_sql_text(k)}, {_sql_text(v)})" for k, v in licenses.TEMPLATES.items())}),
cut as (
  select doc_id, row_number() over () as u, string_split(text, chr(10)) as lines
  from documents where text is not null),
lines as (
  select doc_id, u, cast(unnest(range(1, len(lines) + 1)) as integer) as line,
    unnest(lines) as unit from cut),
units as (
  select doc_id, u, line, unit from lines
  union all select doc_id, u, 0, array_to_string(lines, ' ') from cut where len(lines) > 1
  union all select null, license, -1, body from templates),
words as (
  select doc_id, u, line, list_filter(string_split(
    trim(regexp_replace(lower(unit), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' '),
    lambda w: w <> '') as ws from units),
grams as (
  select doc_id, u, line, list_distinct(case when len(ws) < 2 then ws
    else [ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))] end) as g from words),
parts as (select doc_id, u, line, len(g) as n, unnest(g) as gram from grams),
shared as (
  select p.doc_id, p.u, p.line, t.u as license, 2.0 * count(*) / (p.n + t.n) as score
  from parts p join parts t on t.line = -1 and p.line >= 0 and p.gram = t.gram
  group by p.doc_id, p.u, p.line, t.u, p.n, t.n),
best as (
  select *, count(*) over (partition by doc_id) as n_found,
    row_number() over (partition by doc_id order by score desc, license, line) as r
  from (select doc_id, line, license, cast(score as double) as score from shared
        where cast(score as double) >= {licenses.THRESHOLD}))
select doc_id, license, score, line, n_found from best where r = 1"""


@_query
def op8_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf, "pages"))


SQL["op8_warc"] = """
with sized as (
  select page_id, cast(octet_length(encode(coalesce(html, ''))) as bigint) as payload_bytes,
    sha1(coalesce(html, '')) as payload_digest from pages),
kept as (select *, case when payload_bytes >= 1000 then max(page_id) over (
           partition by payload_digest, payload_bytes) end as keep from sized)
select page_id, payload_bytes, payload_digest,
  case when keep is not null and page_id is distinct from keep then 'revisit'
    else 'response' end as record_type,
  case when keep is not null and page_id is distinct from keep then keep end as refers_to
from kept"""


@_query
def op9_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict")


@_query
def op10_sentence_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return pieces.encode_decode(_table(spark, sf, "documents"), tokenizer_bytes())


@_query
def op11_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf, "documents"))


SQL["op11_phrases"] = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) as piece
  from documents),
cut as (select lang, regexp_extract_all(piece, '[^ 	]+') as w from pieces),
totals as (select lang, sum(len(w)) as n from cut group by lang),
grams as (
  select lang, m, unnest([array_to_string(w[i:i + m - 1], ' ') for i in range(1, len(w) - m + 2)])
    as phrase from cut, range(1, 6) t(m)),
counts as (
  select lang, m, phrase, count(*) as f, string_split(phrase, ' ') as w
  from grams group by lang, m, phrase having count(*) >= 100),
cuts as (
  select c.lang, c.m, c.phrase, c.w, c.f as a, k from counts c, range(1, 5) t(k)
  where c.m >= 2 and k < c.m),
scored as (
  select c.lang, c.phrase, c.a, c.k, x.f as l, y.f as r, t.n,
    cast(1000 as hugeint) * c.a * t.n // (cast(x.f as hugeint) * y.f) as score
  from cuts c join counts x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:c.k], ' ')
    join counts y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.k + 1:c.m], ' ')
    join totals t on t.lang = c.lang),
best as (
  select *, row_number() over (partition by lang, phrase order by score, k) as turn from scored),
inner_parts as (
  select lang, f, array_to_string(w[i:i + size - 1], ' ') as phrase
  from counts, range(2, 5) s(size), range(1, 5) p(i)
  where size < m and i + size - 1 <= m),
holders as (select lang, phrase, max(f) as longest from inner_parts group by lang, phrase),
ranked as (
  select b.*, row_number() over (partition by b.lang order by score desc, a desc, b.phrase) as rank
  from best b left join holders h on h.lang = b.lang and h.phrase = b.phrase
  where turn = 1 and (longest is null or 100 * longest < 100 * a))
select lang, rank, phrase, a, l, r, cast(n as bigint) as n, cast(score as bigint) as score
from ranked where rank <= 2000"""


@_query
def op12_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return embedding_dedup.near_vectors(_table(spark, sf, "embeddings"))


SQL["op12_embedding_dedup"] = """
with recursive numbered as (
  select row_number() over () as r, vec_id, label,
    [cast(x as double) for x in embedding] as v from embeddings),
usable as (
  select *, sqrt(list_sum([x * x for x in v])) as norm from numbered
  where label is not null and v is not null
    and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(v, lambda x: x <> 0)) > 0),
links as (
  select a.r as a, b.r as b, b.vec_id as id from usable a join usable b
  on a.label = b.label and a.r <> b.r and len(a.v) = len(b.v)
    and list_sum([a.v[i] * b.v[i] for i in range(1, len(a.v) + 1)]) / (a.norm * b.norm) >= 0.98),
reach as (
  select r as a, r as b from numbered
  union select reach.a, links.b from reach join links on reach.b = links.a),
smallest as (
  select reach.a, min(n.vec_id) as component_id from reach join numbered n on reach.b = n.r
  group by reach.a),
degrees as (select a, count(*) as n_links from links group by a)
select n.vec_id, coalesce(d.n_links, 0) as n_links, s.component_id,
  coalesce(n.vec_id = s.component_id, false) as kept
from numbered n join smallest s on n.r = s.a left join degrees d on n.r = d.a"""


@_query
def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    return conversations.damaged_repairs(_table(spark, sf, "conversations"))


def _edit_rows() -> str:
    """All ways past a row of a conversation: state, role initial, kind of row, letters, next state,
    cost, what is inserted before it and its role behind it ('-' for none, '=' for its own)."""
    turn = {"start": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}
    rows = []
    for state in turn:
        for initial in "sua?":
            for kind in ("fine", "cut", "gone"):
                at, letters, cost, put = state, "", 0, ""
                for _ in range(3):
                    ways = [("D", at, 2, "-")]
                    if kind != "gone":
                        more = 5 if kind == "cut" else 0
                        ways.append(("R", turn[at], 1 + more, name[turn[at]]))
                        if turn[at] == initial or (at, initial) == ("start", "s"):
                            ways.append(("K", initial, more, "="))
                    rows += [f"('{state}', '{initial}', '{kind}', '{letters}{way}', '{to}', "
                             f"{cost + price}, '{put}', '{role}')" for way, to, price, role in ways]
                    at, letters, cost = turn[at], letters + "I", cost + 5
                    put += name[at] + ":" + chr(10)
    return ", ".join(rows)


SQL["op13_conversation_repair"] = rf"""
with recursive edits(state, initial, kind, letters, after, cost, put, as_role) as (
  values {_edit_rows()}),
ends(state, cost, audit, body) as (values ('start', 0, '', ''), ('a', 0, '', ''),
  ('u', 5, 'I', 'assistant:' || chr(10)),
  ('s', 10, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))),
steps as (
  select list(list_reduce(list_prepend(i, range(8)), lambda c, k:
    case when (c & 1) = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as step
  from range(256) r(i)),
keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as k
  from conversations),
fated as (
  select keyed.*, xor(list_reduce(list_prepend(cast(4294967295 as bigint),
    list_transform(string_split(k, ''), lambda x: cast(ord(x) as bigint))),
    lambda c, b: xor(c >> 8, step[cast(xor(c, b) & 255 as integer) + 1])), 4294967295) % 20 as fate
  from keyed, steps),
damaged as (
  select conv_id, coalesce(cast(conv_id as varchar), '') as conv, turn,
    case when fate = 4 then 'user' else role end as role,
    case when fate = 1 then '' when fate = 2 then regexp_replace(text, '[.!?]', '', 'g')
      else text end as text,
    unnest(case when fate = 3 then [0, 1] else [0] end) as copy
  from fated where fate <> 0),
placed as (
  select *, cast(row_number() over (partition by conv order by turn nulls first, role,
      sha256(length(role) || ':' || role || text), copy) as bigint) as i,
    row_number() over (partition by conv, role, text order by turn nulls first, copy) > 1 as seen,
    rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') as trimmed
  from damaged),
faulty as (
  select *, case when trimmed = '' then 'blank' when seen then 'duplicate'
      when right(trimmed, 1) not in ('.', '!', '?') then 'truncated' end as fault,
    case when left(role, 1) in ('s', 'u', 'a') then left(role, 1) else '?' end as initial,
    lag(left(role, 1)) over (partition by conv order by i) || left(role, 1) as pair
  from placed),
coded as (
  select *, case when fault is null then 'fine' when fault = 'truncated' then 'cut' else 'gone' end
    as kind from faulty),
counted as (
  select conv, max(i) as n, count(*) filter (fault = 'blank') as blank,
    count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) as illegal,
    coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps
  from coded group by conv),
best as (
  select conv, n as i, state, cast(cost as bigint) as cost, audit, body from counted, ends
  union all
  select conv, i, state, m.cost, m.audit, m.body from (
    select r.conv, r.i - 1 as i, e.state, min({{'cost': b.cost + e.cost,
      'audit': e.letters || b.audit, 'body': e.put || case e.as_role when '-' then ''
        when '=' then r.role || ':' || r.text || chr(10)
        else e.as_role || ':' || r.text || chr(10) end || b.body}}) as m
    from best b join coded r on r.conv = b.conv and r.i = b.i
      join edits e on e.initial = r.initial and e.kind = r.kind and e.after = b.state
    group by r.conv, r.i, e.state)),
originals as (select distinct conv_id, coalesce(cast(conv_id as varchar), '') as conv
              from conversations)
select o.conv_id, cast(coalesce(c.gaps, 0) as bigint) as gaps, coalesce(c.blank, 0) as blank,
  coalesce(c.duplicate, 0) as duplicate, coalesce(c.truncated, 0) as truncated,
  coalesce(c.illegal, 0) as illegal, coalesce(b.cost, 0) as cost, coalesce(b.audit, '') as audit,
  sha256(coalesce(left(b.body, length(b.body) - 1), '')) as repaired_sha256
from originals o left join counted c on o.conv = c.conv
  left join best b on o.conv = b.conv and b.i = 0 and b.state = 'start'"""
