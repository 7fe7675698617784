"""The named queries of the operators, with the SQL of their results where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefeed.llm import capfilter, convtrie, decontam, divergence, jaccard, kdtree, langid, linedup, pieces, quality, toxicity, urlrules, warc
from tidefeed.llm.columns import crc_part
from tidefeed.llm.sharing import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql:
            ORACLES[run.__name__] = sql
        return run

    return register


@query(
    r"""
    with low as (
        select 'd' as side, doc_id as id, text from documents union all
        select 'i', item_id, text from benchmark
    ),
    split as (
        select side, id, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
        from low
    ),
    windows as (
        select distinct id as item_id, least(len(words), 13) as size,
               array_to_string(words[i : i + least(len(words), 13) - 1], ' ') as run
        from (select id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) as i
              from split where side = 'i' and len(words) > 0)
    ),
    runs as (
        select id as doc_id, size, i, array_to_string(words[i : i + size - 1], ' ') as run
        from (select id, words, size, unnest(range(1, len(words) - size + 2)) as i
              from split, (select distinct size from windows) where side = 'd' and len(words) >= size)
    ),
    hits as (select doc_id, item_id, i, r.size from runs r join windows w on r.size = w.size and r.run = w.run),
    places as (select doc_id, count(distinct p) as n_hit from (
        select doc_id, unnest(range(i, i + size)) as p from (select distinct doc_id, i, size from hits)) group by 1),
    items as (
        select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as listed
        from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by 1
    )
    select id as doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
           sha256(coalesce(listed, '')) as items_sha256,
           coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words) as contaminated
    from split left join places on id = places.doc_id left join items on id = items.doc_id
    where side = 'd'
    """
)
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the benchmark items whose windows they hold."""
    out = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query()
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every document, seeded by its id, and the text of each."""
    return pieces.encode(table(spark, sf_dir, "documents"), F.col("doc_id"), ["doc_id"], k=2, with_texts=True)


@query(
    """
    with recursive vecs as (
        select vec_id, label, cast(embedding as double[]) as v from embeddings
    ),
    links as (
        select a.vec_id as a, b.vec_id as b from vecs a join vecs b on a.label = b.label and a.vec_id <> b.vec_id
        where list_cosine_similarity(a.v, b.v) >= 0.98
    ),
    reach as (
        select vec_id, vec_id as other from vecs
        union
        select r.vec_id, l.b from reach r join links l on r.other = l.a
    ),
    roots as (select vec_id, min(other) as component_id from reach group by vec_id),
    counts as (select a, count(*) as n from links group by a)
    select r.vec_id, coalesce(n, 0) as n_links, component_id, r.vec_id = component_id as kept
    from roots r left join counts on r.vec_id = counts.a
    """
)
def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with their links at cosine 0.98 and the components of these."""
    return capfilter.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.98)


@query(
    r"""
    with recursive split as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words
        from documents
    ),
    shingles as (
        select distinct doc_id, array_to_string(words[i : i + 4], ' ') as shingle
        from (select doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as i
              from split where len(words) > 0)
    ),
    sizes as (select doc_id, count(*) as n from shingles group by doc_id),
    shared as (
        select a.doc_id as a, b.doc_id as b, count(*) as k
        from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by 1, 2
    ),
    links as (
        select a, b from shared join sizes x on a = x.doc_id join sizes y on b = y.doc_id
        where 100 * k >= 75 * (x.n + y.n - k)
    ),
    reach as (
        select doc_id, doc_id as other from split
        union
        select r.doc_id, l.b from reach r join links l on r.other = l.a
    )
    select split.doc_id, coalesce(n, 0) as n_shingles, component_id
    from split join (select doc_id, min(other) as component_id from reach group by doc_id) c on split.doc_id = c.doc_id
    left join sizes on split.doc_id = sizes.doc_id
    """
)
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the components of near copies by shingles."""
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, ["doc_id"])


@query()
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of good quality for every document; a fifth of the ids is kept from learning."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.learn(docs, labels.where(crc_part("doc_id", 5) != 0))
    docs = docs.select("doc_id", "text", (crc_part("doc_id", 5) == 0).alias("held_out"))
    return quality.score(docs, model, ["doc_id", "held_out"], threshold=0.3)


@query()
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; a quarter of the ids is kept from learning."""
    docs = table(spark, sf_dir, "documents")
    held = (crc_part("doc_id", 4) == 2).alias("held_out")
    model = langid.learn(docs.where(crc_part("doc_id", 4) != 2))
    return langid.predict(docs.select("doc_id", "text", held), model, ["doc_id", "held_out"])


@query(
    """
    with payloads as (
        select page_id, encode(coalesce(html, '')) as payload from pages
    ),
    owners as (select sha1(payload) as sha, max(page_id) as owner from payloads group by 1),
    bits as (
        select page_id, octet_length(payload) as payload_bytes, owner,
               upper(sha1(payload)) as hex
        from payloads join owners on sha1(payload) = sha
    )
    select page_id, payload_bytes,
           list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast(
               list_sum(list_transform(range(0, 5), lambda j: ((
                   (strpos('0123456789ABCDEF', substr(hex, 1 + cast((i * 5 + j) // 4 as int), 1)) - 1)
                   >> cast(3 - ((i * 5 + j) % 4) as int)) & 1) << cast(4 - j as int))) as int), 1)), 'string_agg', '') as payload_digest,
           case when page_id = owner then 'response' else 'revisit' end as record_type,
           case when page_id = owner then null else owner end as refers_to
    from bits
    """
)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC archives and read back."""
    back = warc.round_trip(table(spark, sf_dir, "pages"), min_bytes=0)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(
    r"""
    with lines as (
        select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
        from documents
    ),
    keyed as (
        select doc_id, pos, line,
               translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
        from lines
    ),
    hot as (
        select key, max(doc_id) as last_doc from keyed where length(key) >= 40
        group by key having count(distinct doc_id) >= 5
    ),
    judged as (
        select k.doc_id, k.pos, k.line, (h.key is null or k.doc_id = h.last_doc) as stays
        from keyed k left join hot h on k.key = h.key
    )
    select doc_id, count(*) as n_lines, count(*) filter (where not stays) as n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where stays), '')) as kept_sha256
    from judged group by doc_id
    """
)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents rid of the lines that many of them share."""
    out = linedup.dedup_lines(table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages judged by fixed rules and, where none fits, by rules mined from labels."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    judged = urlrules.judge(pages, urlrules.labelled_pages(pages, labels), urlrules.RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query(
    """
    with vecs as (
        select row_number() over () as r, vec_id, list_transform(cast(embedding as double[]), lambda x: floor(64 * x)) as v
        from embeddings
        where embedding is not null
          and len(list_filter(cast(embedding as double[]), lambda x: x is null or isnan(x) or isinf(x))) = 0
    ),
    scored as (
        select a.r, a.vec_id as query_id, b.vec_id, cast(list_inner_product(a.v, b.v) as bigint) as score,
               row_number() over (partition by a.r order by list_inner_product(a.v, b.v) desc, b.vec_id, b.r) as rank
        from vecs a join vecs b on a.r <> b.r and len(a.v) = len(b.v)
        where a.vec_id % 20 = 0
    )
    select query_id, cast(rank as integer) as rank, vec_id, score from scored where rank <= 20
    """
)
def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best other vectors of every twentieth vector by exact inner product of whole numbers."""
    return kdtree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


@query(
    """
    with recursive ordered as (
        select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
               row_number() over (partition by conv_id order by turn nulls first,
                   md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as i
        from conversations where conv_id is not null
    ),
    ids as (
        select conv_id, list_reduce(list_prepend(4294967295, flatten(list_transform(
                   list_transform(string_split(cast(conv_id as varchar), ''), lambda c: cast(ascii(c) as bigint)),
                   lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1]))),
                   lambda crc, x: case when x >= 0 then xor(crc, x) when crc % 2 = 1 then xor(crc >> 1, 3988292384) else crc >> 1 end
               ) as crc
        from (select distinct conv_id from ordered)
    ),
    taken as (select conv_id, conv_id - conv_id % 100 as head, xor(crc, 4294967295) % 6 as h from ids),
    turns as (
        select t.conv_id, o.i, o.role, o.text from taken t join ordered o on o.conv_id = t.head and o.i <= h
        union all
        select t.conv_id, o.i, o.role, o.text from taken t join ordered o on o.conv_id = t.conv_id and o.i > h
    ),
    placed as (
        select conv_id, row_number() over (partition by conv_id order by i) as depth, text,
               md5(length(role) || ':' || role || text) as token from turns
    ),
    prefixes as (
        select t.conv_id, 0 as depth, '' as prefix, 0 as size from taken t
        union all
        select p.conv_id, p.depth, x.prefix || p.token, length(p.text)
        from prefixes x join placed p on p.conv_id = x.conv_id and p.depth = x.depth + 1
    ),
    lengths as (select conv_id, max(depth) as total from prefixes group by 1),
    nodes as (
        select prefix, depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(size) as size,
               sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where depth = total), '')) as ends_sha256
        from prefixes join lengths using (conv_id) group by 1, 2
    ),
    parents as (
        select c.*, substr(c.prefix, 1, cast(32 * (c.depth - 1) as bigint)) as above,
               (select count(*) from nodes k where k.depth = c.depth + 1 and substr(k.prefix, 1, cast(32 * c.depth as bigint)) = c.prefix) as n_children
        from nodes c
    ),
    subtree as (
        select a.prefix, count(*) filter (where b.n_children = 0) as n_leaves, sum(case when b.depth > 0 then (b.n_convs - 1) * b.size else 0 end) as saved
        from parents a join parents b on b.depth >= a.depth and substr(b.prefix, 1, cast(32 * a.depth as bigint)) = a.prefix
        group by 1
    )
    select c.conv_id, cast(c.depth as bigint) as depth, p.conv_id as parent_conv_id, c.n_convs, c.n_children, n_leaves,
           cast(saved as bigint) as saved_tokens, c.ends_sha256
    from parents c join subtree using (prefix) left join nodes p on c.depth > 0 and p.prefix = c.above
    """
)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt so that many share their first turns."""
    paths = convtrie.turn_paths(table(spark, sf_dir, "conversations"))
    return convtrie.prefix_trie(convtrie.rebuilt(paths))


@query(
    r"""
    with docs as (
        select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as words
        from documents
    ),
    used as (select r, lang, source, unnest(words) as term from docs),
    kept as (select lang, term from used group by lang, term having count(distinct r) >= 30),
    sizes as (select l.lang, count(k.term) as v from (select distinct lang from docs) l left join kept k on k.lang = l.lang group by 1),
    counts as (select lang, source, term, count(*) as n from used join kept using (lang, term) group by all),
    groups as (
        select g.lang, g.source, v, coalesce(total, 0) as total
        from (select distinct lang, source from docs) g join sizes s on s.lang = g.lang
        left join (select lang, source, sum(n) as total from counts group by all) t on t.lang = g.lang and t.source = g.source
    ),
    shares as (
        select g.lang, g.source, k.term, coalesce(n, 0) as n, 1 + (1000000000 * (coalesce(n, 0) + 5)) // (total + 5 * v) as p
        from groups g join kept k on k.lang = g.lang
        left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
    ),
    usual as (
        select lang, term, 1 + (1000000000 * (n + 5)) // (total + 5 * v) as q
        from (select lang, term, sum(n) as n from counts group by all)
        join (select lang, sum(n) as total from counts group by all) using (lang) join sizes using (lang)
    ),
    found as (
        select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
        from groups a join groups b on a.lang = b.lang and a.source <> b.source
        left join (
            select x.lang as x_lang, x.source as s, y.source as o, sum(abs(x.p - y.p)) as value
            from shares x join shares y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by all
        ) on s = a.source and o = b.source and a.lang = x_lang
        union all
        select lang, source, 'term', term, p - q from shares join usual using (lang, term) where n > 0 and p > q
    )
    select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
    from (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from found)
    where part = 'pair' or rank <= 50
    """
)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ in their words."""
    return divergence.divergence(table(spark, sf_dir, "documents"), least=30, top=50)
