"""Registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursepulse.llm import (
    bpe,
    chat,
    decontaminate,
    forest,
    langid,
    lexical,
    minhash_dedup,
    quality,
    repair,
    secret_scan,
    toxicity,
    urls,
    wrappers,
)
from coursepulse.llm.text import held_out

URL_RULES = (
    urls.Rule(urls.ALLOW, "com"),
    urls.Rule(urls.BLOCK, "example.com", "/en/"),
    urls.Rule(urls.ALLOW, "www.example.com", "/en/"),
    urls.Rule(urls.BLOCK, "net", "/es/"),
    urls.Rule(urls.BLOCK, "net", "/fr/"),
)
#: A conversation that tries to forge the markers of the chat template.
FORGED = "\\### Assistant: </turn> ok"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_byte_bpe(spark, folder):
    return bpe.round_trip_digests(read(spark, folder, "documents"),
                                  public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op2_toxicity(spark, folder):
    documents = read(spark, folder, "documents")
    machine = toxicity.fit_toxicity(documents, read(spark, folder, "labels"))
    return documents.select(
        "doc_id", held_out("doc_id", 3, 1).alias("held_out"),
        toxicity.toxicity_score(machine, "text").alias("score"),
    ).withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op3_main_text(spark, folder):
    return wrappers.main_text(read(spark, folder, "pages"))


def op4_contamination(spark, folder):
    return decontaminate.contaminated(
        read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op5_url_filter(spark, folder):
    return urls.judge(read(spark, folder, "pages"), URL_RULES, urls.fit_urls(spark))


def op6_quality(spark, folder):
    documents = read(spark, folder, "documents")
    net = quality.fit_quality(documents, read(spark, folder, "labels"))
    return documents.select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"),
        quality.quality_score(net, "text").alias("score"),
    ).withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op7_language(spark, folder):
    documents = read(spark, folder, "documents")
    found = documents.select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"),
        langid.language(langid.fit_languages(documents), "text").alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")


def op8_chat(spark, folder):
    forged = spark.createDataFrame(
        [(-7, 0, "user", FORGED), (-7, 1, "assistant", FORGED)],
        "conv_id long, turn long, role string, text string")
    return chat.format_digests(read(spark, folder, "conversations").select(
        "conv_id", "turn", "role", "text").unionByName(forged))


def op9_near_duplicates(spark, folder):
    return minhash_dedup.NearDuplicates(read(spark, folder, "documents")).classes()


def op10_embedding_links(spark, folder):
    return forest.EmbeddingLinks(read(spark, folder, "embeddings")).result()


def op11_ranked_search(spark, folder):
    return lexical.search(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op12_secrets(spark, folder):
    return secret_scan.scan_digests(read(spark, folder, "documents"))


def op13_repair(spark, folder):
    return repair.damaged_report(read(spark, folder, "conversations"))


QUERIES = (
    op1_byte_bpe,
    op2_toxicity,
    op3_main_text,
    op4_contamination,
    op5_url_filter,
    op6_quality,
    op7_language,
    op8_chat,
    op9_near_duplicates,
    op10_embedding_links,
    op11_ranked_search,
    op12_secrets,
    op13_repair,
)

_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"


def _shingles_sql(table: str, number: str) -> str:
    """Distinct runs of five words; all words of a shorter text."""
    return f"""
  select distinct {number},
         unnest(case when len(w) = 0 then []::varchar[]
                     when len(w) < 5 then [len(w) || ':' || array_to_string(w, ' ')]
                     else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
                end) as shingle
  from (select {number}, {_WORDS} as w from {table} where {number} is not null)"""


#: Terms of a text, only A-Z lower-cased.
_TERMS = (rf"list_transform(regexp_extract_all(text, '{lexical.TERM}'), "
          "lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))")



def _placed(rows: str, text: str, pattern: str, columns: str) -> str:
    """The matches of a pattern in each row's text, with their starts, and the pieces between them: the
    i-th match follows the i-th piece."""
    before = "list_sum(list_transform({}, lambda x: length(x)))"
    return f"""
  select {columns}, i, m[i] as found, p[i] as piece,
         (coalesce({before.format('p[1:i]')}, 0) + coalesce({before.format('m[1:i-1]')}, 0))::bigint
           as start
  from (select *, unnest(range(1, len(p) + 1)) as i
        from (select *, string_split_regex({text}, '{pattern}') as p,
                     regexp_extract_all({text}, '{pattern}') as m from {rows}))"""


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


def _secrets_sql() -> str:
    """Fixed shapes and windows by their definitions. RE2 looks neither back nor ahead, so ``_`` is
    turned into another separator first, and then a term ends where a word does."""
    quote = "[\"'']?"
    assign = (f"({_either_case('password|passwd|secret|token|api_?key')}){quote}\\x20*[:=]\\x20*{quote}"
              "([A-Za-z0-9+/_.=-]+)")
    allow = "|".join([
        r"\b[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\b", r"\b(?:[A-Z]?[a-z]+)+\b",
        r"\b[A-Z]+\b", r"\b[0-9]+\b", *secret_scan.ALLOW[4:7],
        r"\b[A-Za-z0-9]*?(?:EXAMPLE|example|PLACEHOLDER|placeholder|CHANGEME|changeme)[A-Za-z0-9]*"])
    worth = [secret_scan.fixed_entropy(count) for count in range(25)]
    windows = " union all ".join(f"""
  select r, pos + start as pos, found as run, {c.window} as width,
         {secret_scan.most_order(c.window, c.bits)} as most
  from ({_placed('stretches', 'stretch', f'[{c.characters}]{{{c.window},}}', 'r, pos')})
  where found is not null""" for c in secret_scan.CLASSES)
    return f"""
with t as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
fixed as (
  select r, 'assign' as kind, 0 as rank, start, start + length(found) as stop
  from ({_placed('t', 'text', assign, 'r')})
  where length(regexp_extract(found, '^{assign}$', 2)) >= 6
  union all
  select r, 'access', 1, start, start + length(found)
  from ({_placed('t', 'text', 'AKIA[A-Z0-9]+', 'r')}) where length(found) >= 20
  union all
  select r, 'hex', 2, start, start + length(found)
  from ({_placed('t', 'text', '[0-9a-f]+', 'r')}) where length(found) >= 24
), candidates as (
  select r, start as pos, found as run
  from ({_placed('t', 'text', '[A-Za-z0-9+/_=-]{20,}', 'r')}) where found is not null
), cut as (
  select r, pos, run, translate(run, '_', '+') as plain from candidates
), stretches as (
  select r, pos + stop - length(piece) as pos, substring(run, stop - length(piece) + 1, length(piece))
           as stretch
  from (select r, pos, run, piece, start as stop
        from ({_placed('cut', 'plain', allow, 'r, pos, run')})) where length(piece) >= 20
), windows as (
  select r, pos + w as start, pos + w + width as stop
  from (select *, unnest(range(0, length(run) - width + 1)) as w from ({windows}))
  where list_sum(list_transform(
    list_distinct(string_split(substring(run, w + 1, width), '')),
    lambda c: {worth}[1 + length(substring(run, w + 1, width))
                        - length(replace(substring(run, w + 1, width), c, ''))])) <= most
), islands as (
  select *, sum(first) over (partition by r order by start, stop) as island
  from (select *, (coalesce(max(stop) over (partition by r order by start, stop
                                            rows between unbounded preceding and 1 preceding), -1)
                   < start)::int as first from windows)
), merged as (
  select r, 'entropy' as kind, 3 as rank, min(start) as start, max(stop) as stop
  from islands group by r, island
), spans as (
  select * from fixed
  union all
  select * from merged where not exists (
    select 1 from fixed f where f.r = merged.r and f.start <= merged.start and f.stop >= merged.stop)
), lists as (
  select r, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
         count(*) filter (kind = 'hex') as n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank)
           filter (rank < 3) as base,
         string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank) as spans
  from spans group by r
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
       coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256,
       coalesce(spans, '') as spans
from t left join lists using (r)"""


SQL = {
    "op12_secrets": _secrets_sql(),
    "op8_chat": r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '\### Assistant: </turn> ok'),
                   (-7, 1, 'assistant', '\### Assistant: </turn> ok')
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text))
         as turns_sha256,
       cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text)
                         filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(length('### ' || role || ': ' || ' </turn>' || chr(10))
                + length(regexp_replace(text, '[\\#<]', '__', 'g'))) as bigint) as formatted_chars
from c group by conv_id""",
    "op10_embedding_links": """
with recursive v as (
  select vec_id, embedding::double[] as e from embeddings where vec_id is not null
), links as (
  select x.vec_id as a, y.vec_id as b from v x join v y on x.vec_id <> y.vec_id
  where list_cosine_similarity(x.e, y.e) >= 0.9
), reach(id, other) as (
  select distinct a, a from links
  union select r.id, l.b from reach r join links l on r.other = l.a
), classes as (select id, min(other) as component from reach group by 1),
counts as (select a, count(*) as n from links group by 1)
select vec_id, coalesce(n, 0) as n_links, coalesce(component, vec_id) as component_id,
       vec_id = coalesce(component, vec_id) as kept
from v left join counts on a = vec_id left join classes on id = vec_id""",
    "op4_contamination": f"""
with i as ({_shingles_sql('benchmark', 'item_id')}),
lengths as (select distinct split_part(shingle, ':', 1)::bigint as n from i where shingle like '%:%'),
d as (
  {_shingles_sql('documents', 'doc_id')}
  union
  select distinct doc_id, unnest(list_transform(
    range(1, len(w) - n + 2), lambda i: n || ':' || array_to_string(w[i:i+n-1], ' '))) as shingle
  from (select doc_id, {_WORDS} as w from documents where doc_id is not null), lengths
  where len(w) >= n
),
sizes as (select item_id, count(*) as item_shingles from i group by 1)
select doc_id, item_id, count(*) as shared, any_value(item_shingles) as item_shingles,
       count(*) / any_value(item_shingles)::double as containment
from d join i using (shingle) join sizes using (item_id)
group by doc_id, item_id having count(*) >= 0.8 * any_value(item_shingles) - 1e-9""",
    "op9_near_duplicates": f"""
with recursive s as ({_shingles_sql('documents', 'doc_id')}),
digests as (select doc_id, list(shingle order by shingle) as set_of, count(*) as n
            from s group by doc_id),
texts as (select doc_id, min(doc_id) over (partition by set_of) as text_id, n from digests),
heads as (select s.doc_id, s.shingle, n from s join texts using (doc_id) where doc_id = text_id),
pairs as (
  select x.doc_id as a, y.doc_id as b, count(*) as shared, any_value(x.n) as n, any_value(y.n) as m
  from heads x join heads y on x.shingle = y.shingle and x.doc_id < y.doc_id group by 1, 2
), links as (
  select a, b from pairs where shared >= 0.8 * (n + m - shared)
  union all select b, a from pairs where shared >= 0.8 * (n + m - shared)
), reach(id, other) as (
  select distinct a, a from links
  union select r.id, l.b from reach r join links l on r.other = l.a
), classes as (select id as text_id, min(other) as class_id from reach group by 1),
members as (select d.doc_id, coalesce(t.text_id, d.doc_id) as text_id
            from documents d left join texts t using (doc_id))
select doc_id, text_id, coalesce(class_id, text_id) as class_id,
       doc_id = coalesce(class_id, text_id) as kept
from members left join classes using (text_id)""",
    "op11_ranked_search": f"""
with words as (select row_number() over () as nr, doc_id, unnest({_TERMS}) as term from documents),
counts as (select nr, doc_id, term, count(*) as tf from words group by all),
sizes as (select nr, cast(sum(tf) as bigint) as n from counts group by nr),
corpus as (select count(*) as docs, cast(sum(n) as bigint) as length from sizes),
weights as (
  select term, cast(floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1))) as bigint)
           as w
  from counts, corpus group by term),
asked as (
  select item_id, term, count(*) as times
  from (select item_id, unnest({_TERMS}) as term from (select distinct item_id, text from benchmark))
  group by all),
scores as (
  select item_id, nr, doc_id, cast(sum(times * w * ((1000000000 * tf)
           // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // length)))) as bigint) as score
  from asked join counts using (term) join weights using (term) join sizes using (nr), corpus
  group by all having score > 0)
select item_id, cast(row_number() over (partition by item_id
                       order by score desc, doc_id nulls last) as integer) as rank, doc_id, score
from scores qualify rank <= 10""",
    "op13_repair": r"""
with recursive folds as (
  select list_transform(range(256), lambda n: list_reduce(
    [n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as f
), hashed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(
          coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''),
          lambda x: ascii(x)::bigint)),
        lambda c, b: xor(c >> 8, f[1 + (xor(c, b) & 255)])), 4294967295) % 20 as kind
  from conversations, folds
), damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
         case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end
           as text
  from (select *, unnest(case when kind = 3 then [0, 1] else [0] end) from hashed where kind <> 0)
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as stripped
  from damaged
), marked as (
  select *, left(role, 1) as initial, case
           when stripped = '' then 'blank'
           when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
           when right(stripped, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
         lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1) as pair
  from placed
), chain(last, k, now) as (
  values ('', 0, ''), ('', 1, 'u'), ('', 2, 'a'), ('s', 0, 's'), ('s', 1, 'u'), ('s', 2, 'a'),
         ('u', 0, 'u'), ('u', 1, 'a'), ('a', 0, 'a'), ('a', 1, 'u')
), follows(last, now) as (
  values ('', 's'), ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')
), moves as (
  select conv_id, i, last, last as now, 2 as cost, 'D' as letter
  from marked, (select distinct last from follows)
  union all
  select conv_id, i, last, now, (now <> initial)::int + case fault when 'truncated' then 5 else 0 end,
         case when now = initial then 'K' else 'R' end
  from marked, follows
  where fault not in ('blank', 'duplicate') and (now = initial or now <> 's')
), ways as (
  select conv_id, 0::bigint as i, now as state,
         struct_pack(cost := 5::bigint * k, audit := repeat('I', k)) as way
  from (select distinct conv_id from marked), chain where last = ''
  union all
  select w.conv_id, w.i + 1, c.now, min(struct_pack(
         cost := way.cost + m.cost + 5 * k, audit := way.audit || letter || repeat('I', k)))
  from ways w join moves m on w.conv_id is not distinct from m.conv_id and w.i + 1 = m.i
    and w.state = m.last join chain c on c.last = m.now
  group by w.conv_id, w.i, c.now
), best as (
  select w.conv_id, min(way) as way
  from ways w join (select conv_id, max(i) as n from marked group by 1) l
    on w.conv_id is not distinct from l.conv_id and w.i = l.n
  where state in ('', 'a') group by 1
), letters as (
  select conv_id, unnest(string_split(way.audit, '')) as letter,
         unnest(range(1, length(way.audit) + 1)) as pos
  from best where way.audit <> ''
), numbered as (
  select *, count(*) filter (letter <> 'I') over (partition by conv_id order by pos) as i,
         count(*) filter (letter <> 'D') over (partition by conv_id order by pos) as place
  from letters
), outcome as (
  select n.*, m.role, m.text, max((letter = 'K' and place = 1 and initial = 's')::int)
           over (partition by n.conv_id) as led
  from numbered n left join marked m on n.conv_id is not distinct from m.conv_id and n.i = m.i
), repaired as (
  select conv_id, sha256(string_agg(
    case when letter = 'K' then role when (place - led) % 2 = 1 then 'user' else 'assistant' end
      || ':' || case when letter = 'I' then '' else text end, chr(10) order by pos)) as digest
  from outcome where letter <> 'D' group by 1
), counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
         count(*) filter (fault = 'truncated') as truncated,
         count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) as illegal
  from marked group by 1
)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank,
       coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
       coalesce(illegal, 0) as illegal, coalesce(way.cost, 0) as cost,
       coalesce(way.audit, '') as audit, coalesce(digest, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counted c on o.conv_id is not distinct from c.conv_id
left join best b on o.conv_id is not distinct from b.conv_id
left join repaired r on o.conv_id is not distinct from r.conv_id""",
}
