"""The same queries as plain SQL for DuckDB, written from the definitions rather than from the Spark plans.

Word lists are handed over as ``VALUES``; everything else is computed in SQL over the whole tables.
"""

from __future__ import annotations

import os
import zipfile
from functools import cache
from pathlib import Path

import pyspark

from postsift.functions import lexicons as lx
from postsift.functions import text as tx
from postsift.operators.lemmas import ENGLISH_ENDINGS
from postsift.plans.queries import CATEGORIES, DECORATION
from postsift.settings import LANGUAGES, PUNCTUATION


def q(s) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def values(rows, columns: str) -> str:
    body = ", ".join("(" + ", ".join(q(c) if isinstance(c, str) else str(c) for c in r) + ")" for r in rows)
    return f"(values {body}) as v({columns})"


@cache
def stopword_list(name: str) -> tuple[str, ...]:
    """The list Spark ships: from the running session, or from the jars of the Spark installation."""
    from pyspark import SparkContext

    if SparkContext._active_spark_context is not None:
        from pyspark.ml.feature import StopWordsRemover

        return tuple(StopWordsRemover.loadDefaultStopWords(name))
    homes = [os.environ["SPARK_HOME"]] if "SPARK_HOME" in os.environ else []
    for jar in (j for h in [*homes, Path(pyspark.__file__).parent] for j in (Path(h) / "jars").glob("spark-mllib_*.jar")):
        with zipfile.ZipFile(jar) as z:
            words = z.read(f"org/apache/spark/ml/feature/stopwords/{name}.txt").decode("utf-8")
        return tuple(w for w in words.splitlines() if w)
    raise LookupError(f"no running session and no Spark jars to read the stopwords {name!r} from")


SPACES = q(tx.SPACE + "+")


def collapse(e: str) -> str:
    return f"trim(regexp_replace({e}, {SPACES}, ' ', 'g'))"


def strip_punctuation(e: str) -> str:
    return f"translate({e}, {q(PUNCTUATION)}, '')"


def drop(e: str, pattern: str, by: str = " ") -> str:
    return f"regexp_replace({e}, {q(pattern)}, {q(by)}, 'g')"


def pieces(e: str, pattern: str, replacement: str) -> str:
    """Replace each match ``p[2]`` of the pattern by an expression over it."""
    p = q(pattern)
    return (
        f"array_to_string(list_transform(list_zip(string_split_regex({e}, {p}), regexp_extract_all({e}, {p})), "
        f"lambda p: p[1] || case when p[2] is null then '' else {replacement} end), '')"
    )


def clean(source: str, text: str = "text", keys: str = "*") -> str:
    """Initial clean without markup: lower case, links, mentions, hashtags, spaces."""
    e = drop(drop(drop(f"lower(coalesce({text}, ''))", tx.URL), tx.MENTION), tx.HASHTAG)
    return f"select {keys}, {collapse(e)} as clean from {source}"


def markup_to_text(e: str) -> str:
    bare = drop(drop(e, tx.HTML_HIDDEN, ""), tx.HTML_TAG, "")
    hexa = "('0x' || lpad(regexp_replace(p[2][4:], ';', ''), 8, '0'))::bigint"
    deci = "regexp_replace(p[2][3:], ';', '')::bigint"
    entity = (
        f"case when p[2][2:3] in ('#x', '#X') then chr(({hexa})::int) when p[2][2:2] = '#' then chr(({deci})::int) "
        "else coalesce(names[p[2][2:-2]], p[2]) end"
    )
    return pieces(bare, tx.HTML_ENTITY, entity)


def entity_names() -> str:
    """A one-row table ``names`` with the map of entity names."""
    return (
        "select map(list(k order by k), list(v order by k)) as names from "
        + values(sorted(tx.named_entities().items()), "k, v")
    )


def language_maps(lexicon: lx.Lexicon) -> str:
    """``(lang, m)``: one map per language."""
    return (
        "select lang, map(list(k order by k), list(v order by k)) as m from "
        + values(lexicon.rows(), "lang, k, v")
        + " group by lang"
    )


LANGUAGE_BY_TURN = (
    "case (conv_id + turn) % 8 " + " ".join(f"when {i} then {q(g)}" for i, g in enumerate(LANGUAGES)) + " end"
)
DECORATED = (
    f"select conv_id, turn, lang, text || suffix as text from (select *, {LANGUAGE_BY_TURN} as lang from conversations) "
    f"join {values(sorted(DECORATION.items()), 'lang, suffix')} using (lang)"
)


def emoji_blocks() -> str:
    parts = []
    for i, (first, names) in enumerate(lx.emoji_tags()):
        parts.append("[" + ", ".join(q(n) for n in names) + f"] as block{i}")
    return "select " + ", ".join(parts)


def emoji(e: str) -> str:
    cases = " ".join(
        f"when unicode(p[2]) between {first} and {first + len(names) - 1} then block{i}[unicode(p[2]) - {first} + 1]"
        for i, (first, names) in enumerate(lx.emoji_tags())
    )
    flag = "when unicode(p[2]) between 127462 and 127487 and unicode(p[2][2:2]) between 127462 and 127487 then 'emoji_flag_'"
    flag += " || chr((unicode(p[2]) - 127365)::int) || chr((unicode(p[2][2:2]) - 127365)::int)"
    keycap = f"when ends_with(p[2], chr(8419)) then 'emoji_keycap_' || case p[2][1:1] when '#' then 'hash' when '*' then 'star' else p[2][1:1] end"
    return pieces(e, lx.EMOJI_PATTERN, f"' ' || coalesce(em[p[2]], case {flag} {keycap} {cases} else p[2] end) || ' '")


def emoticons(e: str) -> str:
    keys = sorted({k for t in lx.emoticons(LANGUAGES).entries.values() for k in t if not lx.is_emoji(k)})
    pattern = "(?i)(?:" + lx.alternation(keys) + ")"
    return pieces(e, pattern, "' ' || coalesce(em[lower(p[2])], p[2]) || ' '")


def each_word(e: str, replacement: str) -> str:
    return f"array_to_string(list_transform(string_split({e}, ' '), lambda w: {replacement}), ' ')"


def lemma(w: str, lang: str = "lang", m: str = "lm") -> str:
    return (
        f"coalesce({m}[lower({w})], case when {lang} <> 'en' or {w} in ({', '.join(map(q, lx.NOT_PLURAL))}) then {w} "
        f"when regexp_matches({w}, '^[a-z]{{2,}}[^aeiou]ies$') then regexp_replace({w}, 'ies$', 'y') "
        f"when regexp_matches({w}, '^[a-z]{{2,}}(?:ss|x|zz|ch|sh)es$') then regexp_replace({w}, 'es$', '') "
        f"when regexp_matches({w}, '^[a-z]{{2,}}[^sui]s$') then regexp_replace({w}, 's$', '') else {w} end)"
    )


def bucket(key: str, buckets: int = 10_000) -> str:
    return f"('0x' || substr(md5('42:' || {key}), 1, 8))::bigint % {buckets}"


def split_of(key: str) -> str:
    b = bucket(key)
    return f"case when {b} < 7000 then 'discovery' when {b} < 9000 then 'validation' else 'evaluation' end"


# Shared parts


def terms(source: str, group: str, text: str, stop=()) -> str:
    """``(grp, doc, term)``: words of two or more characters and their pairs, stopwords dropped first."""
    toks = f"regexp_extract_all(lower({text}), {q(tx.TOKEN)})"
    if stop:
        toks = f"list_filter({toks}, lambda w: not list_contains(stop.words, w))"
        source += ", (select list(w) as words from " + values([(w,) for w in stop], "w") + ") stop"
    return f"""
      toks as (select {group} as grp, row_number() over () as doc, {toks} as t from {source} where {text} is not null),
      single as (select grp, doc, generate_subscripts(t, 1) as i, unnest(t) as term from toks),
      paired as (select grp, doc, term || ' ' || lead(term) over (partition by doc order by i) as term from single),
      terms as (select grp, doc, term from single union all select grp, doc, term from paired where term is not null)"""


def ranked(group: str, counts: str, n: int) -> str:
    return f"""select {group}, term, n, rank::int as rank from (select grp as {group}, term, n,
      row_number() over (partition by grp order by n desc, term) as rank from {counts}) where rank <= {n}"""


CENTRES = """
  vec as (select vec_id, label, unnest(embedding::double[]) as x, generate_subscripts(embedding, 1) as i from embeddings),
  centre as (select label, i, avg(x) as c from vec group by label, i),
  centres as (select label, list(c order by i) as centre from centre group by label)"""

NEAREST = f"""{CENTRES},
  dist as (select e.vec_id, e.label, c.label as nearest, list_distance(e.embedding::double[], c.centre) as distance
    from embeddings e, centres c),
  near as (select * from (select *, row_number() over (partition by vec_id order by distance, nearest) as r from dist) where r = 1),
  guess as (select vec_id, {split_of("vec_id")} as split, label, nearest from near)"""

REPORT = """
  cells as (select split, label, nearest, count(*) as n from guess group by all),
  classes as (select split, label as class from cells union select split, nearest from cells),
  counts as (select split, class,
    coalesce((select sum(n) from cells c where c.split = k.split and c.label = k.class), 0) as support,
    coalesce((select sum(n) from cells c where c.split = k.split and c.nearest = k.class), 0) as predicted,
    coalesce((select sum(n) from cells c where c.split = k.split and c.label = k.class and c.nearest = k.class), 0) as good
    from classes k),
  pr as (select *, coalesce(good / nullif(predicted, 0), 0) as p, coalesce(good / nullif(support, 0), 0) as r from counts),
  per as (select *, coalesce(2 * p * r / nullif(p + r, 0), 0) as f from pr),
  rep as (
    select split, class::varchar as class, p as "precision", r as recall, f as f1, support::bigint as support from per
    union all select split, 'accuracy', sum(good) / sum(support), sum(good) / sum(support), sum(good) / sum(support), sum(support)::bigint from per group by split
    union all select split, 'macro avg', avg(p), avg(r), avg(f), sum(support)::bigint from per group by split
    union all select split, 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support), sum(f * support) / sum(support), sum(support)::bigint from per group by split)"""

NAMES = values(sorted(CATEGORIES.items()), "cluster_id, category")
NAMED = f"select e.vec_id, e.label, v.category from embeddings e left join {NAMES} on v.cluster_id = e.label"

# Words of the cleaned documents with their counts, and the frequent ones that serve as dictionary.
VOCABULARY = f"""
  docs as (select doc_id, lang, {collapse(strip_punctuation("lower(text)"))} as text from documents),
  vocab as (select lang, token, count(*) as n from (select lang, unnest(string_split(text, ' ')) as token from docs)
    where token <> '' group by all),
  known as (select lang, token as word, n from vocab where n >= 5 and regexp_matches(token, '^\\p{{L}}{{2,}}$')),
  unknown as (select lang, token as word from vocab v where regexp_matches(token, '^\\p{{L}}{{3,}}$')
    and not exists (select 1 from known k where k.lang = v.lang and k.word = v.token))"""


def letters(w: str) -> str:
    """One byte per letter: DuckDB measures distances in bytes."""
    return f"translate({w}, 'äöüßéèêçñáíóúàâîôûëïœìò', 'ABCDEFGHIJKLMNOPQRSTUVW')"


def shorter(w: str) -> str:
    """All words that lack one character of ``w``."""
    return f"list_transform(range(1, length({w}) + 1), lambda i: {w}[:i-1] || {w}[i+1:])"


NEAR = f"""{VOCABULARY},
  known1 as (select lang, word, n, unnest(list_distinct(list_append({shorter("word")}, word))) as form from known),
  unknown1 as (select lang, word, unnest(list_distinct(list_append({shorter("word")}, word))) as form from unknown),
  pairs1 as (select distinct u.lang, u.word, k.word as correction, k.n from unknown1 u join known1 k using (lang, form)
    where damerau_levenshtein({letters("u.word")}, {letters("k.word")}) = 1),
  best1 as (select lang, word, correction from (select *, row_number() over (partition by lang, word order by n desc, correction) as r
    from pairs1) where r = 1)"""

FAR = f"""{NEAR},
  rest as (select lang, word from unknown u where not exists (select 1 from best1 b where b.lang = u.lang and b.word = u.word)),
  known2a as (select distinct lang, word, n, form from known1),
  known2 as (select distinct lang, word, n, unnest(list_append({shorter("form")}, form)) as form from known2a),
  rest1 as (select lang, word, unnest(list_append({shorter("word")}, word)) as form from rest),
  rest2 as (select distinct lang, word, unnest(list_append({shorter("form")}, form)) as form from rest1),
  pairs2 as (select distinct u.lang, u.word, k.word as correction, k.n from rest2 u join known2 k using (lang, form)
    where levenshtein({letters("u.word")}, {letters("k.word")}) <= 2),
  best2 as (select lang, word, correction from (select *, row_number() over (partition by lang, word order by n desc, correction) as r
    from pairs2) where r = 1)"""

# Trigrams over letters, naive Bayes with add-one smoothing.
DETECTED = f"""
  padded as (select doc_id, lang, ' ' || trim({drop("lower(text)", r"[^\p{L}]+")}) || ' ' as t from documents),
  chars as (select doc_id, lang, unnest(string_split(t, '')) as c, generate_subscripts(string_split(t, ''), 1) as i
    from padded where trim(t) <> ''),
  tri as (select doc_id, lang, c || lead(c, 1) over w || lead(c, 2) over w as g from chars window w as (partition by doc_id order by i)),
  per_doc as (select doc_id, lang, g, count(*) as n from tri where g is not null group by all),
  learned as (select * from per_doc where {split_of("doc_id")} = 'discovery'),
  per_lang as (select lang, g, sum(n) as n from learned group by all),
  size as (select count(distinct g) as v from per_lang),
  langs as (select lang, count(distinct doc_id) as docs from learned group by lang),
  total as (select lang, sum(n) as n from per_lang group by lang),
  prior as (select lang, ln(docs + 1) - ln((select sum(docs) from langs) + (select count(*) from langs)) as p from langs),
  weight as (select l.lang, g.g, ln(coalesce(p.n, 0) + 1) - ln(t.n + (select v from size)) as w
    from langs l cross join (select distinct g from per_lang) g join total t on t.lang = l.lang
    left join per_lang p on p.lang = l.lang and p.g = g.g),
  score as (select d.doc_id, w.lang, sum(d.n * w.w) + any_value(prior.p) as s from per_doc d join weight w on w.g = d.g
    join prior on prior.lang = w.lang group by d.doc_id, w.lang),
  best as (select doc_id, lang as guess from (select *, row_number() over (partition by doc_id order by round(s, 6) desc, lang) as r from score) where r = 1),
  detected as (select d.doc_id, d.lang, {split_of("d.doc_id")} as split, coalesce(b.guess, 'unknown') as detected_language from documents d left join best b using (doc_id))"""


NEED_STOPWORDS = ("customer_keywords", "stopword_filter", "cluster_keywords", "cluster_report")


@cache
def oracles() -> dict[str, str]:
    try:
        stop = {c: stopword_list(lx.STOPWORD_LISTS[c]) for c in LANGUAGES}
    except LookupError:  # the SQL that needs the words is left out below
        stop = dict.fromkeys(LANGUAGES, ("",))
    english = stop["en"]
    o: dict[str, str] = {}

    # Sources, filters, splits
    blank = drop("coalesce(text, '')", tx.SPACE + "+", "")
    o["customer_messages"] = f"select conv_id, turn, text from conversations where role = 'user' and {blank} <> ''"
    user_text = f"(select turn, {strip_punctuation('clean')} as text from ({clean('conversations')}) where role = 'user' and {blank} <> '')"
    o["customer_keywords"] = f"""with {terms(user_text, "turn", "text", english)}
      {ranked("turn", "(select grp, term, count(*) as n from terms group by all)", 15)}"""
    o["csv_round_trip"] = """select conv_id * 1000 + turn as tweet_id, role as author_id, role = 'user' as inbound, text,
      'Tue Oct 31 22:10:47 +0000 2017' as created_at, case when turn > 0 then conv_id * 1000 + turn - 1 end as in_response_to_tweet_id,
      (conv_id * 1000 + turn + 1)::varchar as response_tweet_id from conversations"""
    o["csv_one_file"] = o["csv_round_trip"]
    o["prepared_messages"] = f"""select conv_id * 1000 + turn as tweet_id, {split_of("(conv_id * 1000 + turn)")} as split, text,
      epoch(try_strptime('Tue Oct 31 22:10:47 +0000 2017', '%a %b %d %H:%M:%S %z %Y'))::bigint as created_at,
      case when turn > 0 then conv_id * 1000 + turn - 1 end as in_response_to_tweet_id, length(text)::int as tweet_length
      from conversations where role = 'user' and {blank} <> ''"""
    o["stage_by_split"] = f"""select * from (select conv_id * 1000 + turn as tweet_id, role as author_id,
      {split_of("(conv_id * 1000 + turn)")} as split from conversations) where split = 'validation'"""
    o["vector_round_trip"] = """select vec_id, len(embedding)::bigint as dims, round(embedding[1]::double, 6) as "first",
      round(embedding[-1]::double, 6) as "last" from embeddings"""
    o["csv_quality"] = f"""with m as (select role, turn, text from conversations)
      select 'readable' as rule, count(*) as n_rows, count(*) filter (role <> 'user') as n_failed from m
      union all select 'is_reply', count(*), count(*) filter (turn = 0) from m
      union all select 'has_text', count(*), count(*) filter ({blank} = '') from m"""
    o["sample_export"] = """select doc_id, source, text from (select *, row_number() over (partition by source
      order by md5('42:' || doc_id), doc_id) as r from documents) where r <= 100"""
    o["split_assign"] = f"select doc_id, {split_of('doc_id')} as split from documents"
    o["split_exact"] = """with h as (select doc_id, row_number() over (order by ('0x' || substr(md5('42:' || doc_id), 1, 15))::bigint) - 1 as r from documents),
      n as (select floor(0.7 * count(*)) as a, count(*) as n from documents)
      select doc_id, case when r < a then 'discovery' when r < a + floor((n - a) * 2 / 3 + 1e-9) then 'validation' else 'evaluation' end as split from h, n"""
    o["split_sizes"] = f"""select split, count(*) as n_rows, round(100.0 * count(*) / (select count(*) from documents), 6) as pct
      from (select {split_of("doc_id")} as split from documents) group by split"""
    o["dedup_first_message"] = """select conv_id, turn, role, text from
      (select *, row_number() over (partition by conv_id order by turn, text) as r from conversations) where r = 1"""
    o["dedup_over_stream"] = o["dedup_first_message"]
    o["dedup_report"] = """select count(*)::bigint as rows_before, count(distinct conv_id)::bigint as rows_after,
      (count(*) - count(distinct conv_id))::bigint as rows_dropped from conversations"""
    o["dedup_exact_text"] = """select doc_id, lang, source, md5(text) as digest from
      (select *, row_number() over (partition by text order by doc_id) as r from documents) where r = 1"""
    o["parse_timestamps"] = """with w as (select event_id, case event_type when 'error' then 'garbage'
        when 'click' then strftime(ts, '%Y-%m-%dT%H:%M:%SZ') else strftime(ts, '%a %b %d %H:%M:%S +0000 %Y') end as t from events)
      select event_id, epoch(coalesce(try_strptime(t, '%a %b %d %H:%M:%S %z %Y'), try_strptime(t, '%Y-%m-%dT%H:%M:%SZ')))::bigint as created_at from w"""
    o["text_length"] = "select doc_id, length(coalesce(text, ''))::bigint as tweet_length from documents"

    # Text steps
    o["html_to_text"] = f"""with names as ({entity_names()})
      select page_id, {collapse(markup_to_text("html"))} as text from pages, names"""
    built = "'Hola @señor_' || page_id || ' mira ' || url || ' ya #año' || page_id || ' www.x.y/z fin'"
    o["strip_urls_mentions_hashtags"] = f"""select page_id, clean as text from
      ({clean(f"(select page_id, {built} as raw from pages)", "raw")})"""
    o["emoticon_expand"] = f"""with lex as (select lang, m as em from ({language_maps(lx.emoticons(LANGUAGES))})),
      blocks as ({emoji_blocks()}), d as ({DECORATED}),
      tagged as (select conv_id, turn, em, {emoji("text")} as text from d join lex using (lang), blocks)
      select conv_id, turn, {collapse(emoticons("text"))} as text from tagged"""
    chat = f"""lex as ({language_maps(lx.chat_words())})"""
    o["chatword_expand"] = f"""with {chat}, d as (select conv_id, turn, lang, {collapse("text")} as text from ({DECORATED}))
      select conv_id, turn, {collapse(each_word("text", "coalesce(m[lower(w)], w)"))} as text from d left join lex using (lang)"""
    o["punctuation_strip"] = f"select doc_id, {strip_punctuation('text')} as text from documents"
    stops = values([(c, w) for c in LANGUAGES for w in stop[c]], "lang, w")
    o["stopword_filter"] = f"""with stop as (select lang, list(w) as words from {stops} group by lang),
      d as (select doc_id, lang, {collapse("lower(text)")} as text from documents)
      select doc_id, array_to_string(list_filter(string_split(text, ' '), lambda w: not list_contains(words, w)), ' ') as text
      from d join stop using (lang)"""
    lemma_lex = f"lml as (select lang, m as lm from ({language_maps(lx.lemmas())}))"
    o["lemma_words"] = f"""with {lemma_lex},
      d as (select doc_id, lang, {collapse(strip_punctuation("lower(text)"))} as text from documents)
      select doc_id, {each_word("text", lemma("w"))} as text from d left join lml using (lang)"""
    o["normalise_chain"] = f"""with lex as (select lang, m as em from ({language_maps(lx.emoticons(LANGUAGES))})),
      chatlex as (select lang, m as cm from ({language_maps(lx.chat_words())})), {lemma_lex},
      blocks as ({emoji_blocks()}), names as ({entity_names()}),
      low as (select conv_id, turn, lang, lower(text) as text from ({DECORATED})),
      bare as (select conv_id, turn, lang, case when contains(text, '<') and contains(text, '>') then {markup_to_text("text")} else text end as text from low, names),
      c as ({clean("bare", "text", "conv_id, turn, lang")}),
      s1 as (select conv_id, turn, lang, em, {emoji("clean")} as t from c join lex using (lang), blocks),
      s2 as (select conv_id, turn, lang, {collapse(emoticons("t"))} as t from s1),
      s3 as (select conv_id, turn, lang, {each_word("t", "coalesce(cm[lower(w)], w)")} as t from s2 left join chatlex using (lang)),
      s4 as (select conv_id, turn, lang, {collapse(strip_punctuation("t"))} as t from s3)
      select conv_id, turn, {collapse(each_word("t", lemma("w")))} as text_preprocessed from s4 left join lml using (lang)"""
    o["vocabulary"] = f"with {VOCABULARY} select lang, token, n from vocab"
    endings = values([(r, a, b) for r, (a, b) in enumerate(ENGLISH_ENDINGS)], "rank, old, new")

    def by_lexicon_and_ending(known: str) -> str:
        return f"""lexicon as (select * from {values(lx.lemmas().rows(), "lang, form, lemma")}),
          open as (select v.lang, v.token from (select * from vocab where lang = 'en') v
            anti join lexicon l on l.lang = v.lang and l.form = v.token anti join {known} k on k.lang = v.lang and k.word = v.token),
          tails as (select lang, token, right(token, k) as old from open, unnest([1, 2, 3, 4]) as u(k) where length(token) > k),
          tries as (select lang, token, rank, left(token, length(token) - length(old)) || new as word from tails join {endings} using (old)
            where length(token) >= 3 + length(old) - length(new)),
          good as (select t.*, row_number() over (partition by t.token order by rank) as r from tries t join {known} k using (lang, word)),
          english as (select v.lang, v.token, l.lemma as value from vocab v join lexicon l on l.lang = v.lang and l.form = v.token
            union all select lang, token, word from good where r = 1)"""

    o["lemma_learn"] = f"with {VOCABULARY}, {by_lexicon_and_ending('known')} from english"
    learned = f"""{VOCABULARY}, twice as (select lang, token as word, n from vocab where n >= 2 and regexp_matches(token, '^\\p{{L}}{{2,}}$')),
      cut as (select lang, word, n, left(word, length(word) - k) as stem, right(word, k) as ending from twice, unnest([0, 1, 2, 3, 4]) as u(k) where length(word) - k >= 3),
      often as (select lang, ending, count(*) as stems, sum(n) as uses from cut group by all having count(*) >= 10),
      few as (select c.* from cut c join often using (lang, ending)),
      pairs as (select a.lang, a.ending as old, b.ending as new, count(*) as stems from few a join few b using (lang, stem)
        where a.ending <> b.ending and left(a.ending, 1) <> left(b.ending, 1) group by all having count(*) >= 10),
      rules as (select p.lang, old, new, p.stems, p.stems / a.stems as share from pairs p join often a on a.lang = p.lang and a.ending = old
        join often b on b.lang = p.lang and b.ending = new where p.stems / a.stems >= 0.5
        and (-b.stems, -b.uses, length(new), new) < (-a.stems, -a.uses, length(old), old))"""
    o["lemma_paradigms"] = f"with {learned} select lang, old, new, stems, round(share, 6) as share from rules"
    o["lemma_by_paradigm"] = f"""with {learned}, {by_lexicon_and_ending("twice")},
      free as (select v.lang, v.token from (select * from vocab where lang <> 'en') v anti join lexicon l on l.lang = v.lang and l.form = v.token),
      tried as (select f.lang, token, left(token, length(token) - k) || new as lemma, share, stems, old from free f, unnest([0, 1, 2, 3, 4]) as u(k)
        join rules r on r.lang = f.lang and r.old = right(token, k) where length(token) - k >= 3),
      best as (select t.*, row_number() over (partition by t.lang, token order by share desc, stems desc, length(old) desc, lemma) as r
        from tried t join twice k on k.lang = t.lang and k.word = t.lemma)
      select lang, token, value from english union all select lang, token, lemma from best where r = 1"""
    o["spell_near"] = f"with {NEAR} select lang, word, correction, 1 as distance from best1"
    o["spell_correct"] = f"""with {FAR} select lang, word, correction, 1 as distance from best1
      union all select lang, word, correction, 2 from best2"""
    o["spell_by_parts"] = o["spell_correct"]
    o["spell_apply"] = f"""with {FAR}, best as (from best1 union all from best2),
      w as (select doc_id, lang, unnest(string_split(text, ' ')) as word, generate_subscripts(string_split(text, ' '), 1) as i from docs)
      select doc_id, string_agg(coalesce(b.correction, w.word), ' ' order by i) as text from w left join best b using (lang, word) group by doc_id"""
    o["language_detect"] = f"with {DETECTED} select doc_id, detected_language from detected"
    o["language_confusion"] = f"with {DETECTED} select split, lang, detected_language, count(*) as n from detected group by all"

    # Features and clusters
    o["tfidf_terms"] = f"""with t as (select distinct doc_id, unnest(regexp_extract_all(lower(text), {q(tx.TOKEN)})) as term from documents)
      select term, count(*) as df, round(ln(((select count(*) from documents) + 1) / (count(*) + 1)), 6) as idf from t group by term"""
    o["user_encoder"] = """with l as (select unnest(range(26)) as position),
      c as (select doc_id, position, length(text) - length(replace(lower(text), chr((97 + position)::int), '')) as n from (select doc_id, lower(text) as text from documents), l)
      select doc_id, position::bigint as position, round((n::float / greatest(sum(n) over (partition by doc_id), 1)::float)::double, 5) as share from c"""
    o["nearest_centroid"] = f"with {NEAREST} select vec_id, nearest, round(distance, 6) as distance from near"
    o["cluster_sizes"] = "select label, count(*) as n_rows from embeddings group by label"
    o["label_clusters"] = NAMED
    o["category_distribution"] = f"select category, count(*) as n_rows from ({NAMED}) group by category"
    o["unmapped_clusters"] = f"select label, count(*) as n_rows from ({NAMED}) where category is null group by label"
    by_source = f"""{terms("documents", "source", "text", english)},
      top as ({ranked("source", "(select grp, term, count(*) as n from terms group by all)", 15)})"""
    o["cluster_keywords"] = f"with {by_source} select source, term, n, rank from top"
    o["cluster_keywords_by_share"] = f"""with {terms("documents", "lang", "text")},
      counts as (select grp, term, count(*) as n, count(distinct doc) as docs from terms group by all),
      sizes as (select lang as grp, count(*) as docs from documents where text is not null group by lang),
      kept as (select c.grp, c.term, c.n from counts c join sizes s using (grp) where c.docs <= 0.9 * s.docs
        and c.docs >= case when s.docs > 100 then greatest(2, floor(s.docs * 0.005)) else 1 end)
      {ranked("lang", "kept", 20)}"""
    sample = "select source, doc_id, row_number() over (partition by source order by md5('42:' || doc_id), doc_id) as sample_rank from documents"
    o["cluster_sample"] = f"select source, doc_id, sample_rank from ({sample}) where sample_rank <= 50"
    o["cluster_report"] = f"""with {by_source},
      kw as (select source, string_agg(term, '|' order by rank) as keywords from top group by source),
      sm as (select source, string_agg(doc_id::varchar, '|' order by sample_rank) as sample_ids from ({sample}) where sample_rank <= 50 group by source),
      n as (select source, count(*) as n_rows from documents group by source)
      select source, n_rows, coalesce(keywords, '') as keywords, sample_ids, '[NAME ME]' as category_slot
      from n left join kw using (source) left join sm using (source)"""
    o["cluster_report_text"] = f"""with {terms("documents", "source", "text")},
      top as ({ranked("source", "(select grp, term, count(*) as n from terms group by all)", 10)}),
      kw as (select source, string_agg(term, ', ' order by rank) as keywords from top group by source),
      shown as (select s.source, s.sample_rank, '  doc_id: ' || doc_id || chr(10) || '  text: ' ||
          case when text is null then '[TEXT MISSING]' when {blank} = '' then '[TEXT BLANK]' else text end as line
        from ({sample}) s join documents using (doc_id) where s.sample_rank <= 5),
      sm as (select source, string_agg(line, chr(10) || '--' || chr(10) order by sample_rank) as samples from shown group by source),
      n as (select source, count(*) as n from documents group by source)
      select source, '== cluster ' || source || ' (' || n || ' rows) ==' || chr(10) || samples || chr(10) ||
        'keywords: ' || coalesce(keywords, '') || chr(10) || 'name: [NAME ME]' as report from n join kw using (source) join sm using (source)"""
    o["pseudo_labelled"] = f"""select e.vec_id as tweet_id, d.text, e.label as cluster_id, e.category, d.source as author_id
      from ({NAMED}) e left join documents d on d.doc_id = e.vec_id"""

    # Cluster validity
    spread = f"{CENTRES}, sq as (select v.label, sum((x - c) * (x - c)) as w from vec v join centre using (label, i) group by v.label)"
    o["wcss"] = f"with {spread} select round(sum(w), 5) as wcss from sq"
    o["calinski_harabasz"] = f"""with {spread}, al as (select i, avg(x) as m from vec group by i),
      n as (select label, count(*) as n from embeddings group by label),
      b as (select sum(n.n * (c - m) * (c - m)) as b from centre join al using (i) join n using (label)),
      k as (select count(*) as k, sum(n) as n from n)
      select round((b / (k - 1)) / ((select sum(w) from sq) / (n - k)), 6) as calinski_harabasz from b, k"""
    o["davies_bouldin"] = f"""with {CENTRES},
      s as (select e.label, avg(list_distance(e.embedding::double[], c.centre)) as s from embeddings e join centres c using (label) group by e.label),
      sc as (select label, s, centre from s join centres using (label)),
      r as (select a.label, max((a.s + b.s) / list_distance(a.centre, b.centre)) as r from sc a join sc b on a.label <> b.label group by a.label)
      select round(avg(r), 6) as davies_bouldin from r"""
    o["silhouette_cosine"] = """with p as (select a.vec_id, a.label as own, b.label as other, b.vec_id as vec_b,
        1 - list_cosine_similarity(a.embedding::double[], b.embedding::double[]) as d from embeddings a, embeddings b where a.vec_id <> b.vec_id),
      m as (select vec_id, own, other, avg(d) as d from p group by all),
      ab as (select vec_id, max(d) filter (own = other) as a, min(d) filter (own <> other) as b from m group by vec_id)
      select round(avg(case when a is null then 0 else (b - a) / greatest(a, b) end), 6) as silhouette from ab"""
    o["metric_sample"] = f"select vec_id from embeddings where {bucket('vec_id', 1_000_000)} < 500000"

    # Classifier
    o["align_features_labels"] = """select * from (select e.vec_id as tweet_id, case when toxic = 1 then 'toxic' when quality = 1 then 'good' end as category,
      len(embedding)::bigint as dims from embeddings e join labels l on l.doc_id = e.vec_id) where category is not null"""
    o["missing_vectors"] = "select doc_id from labels where doc_id not in (select vec_id from embeddings)"
    o["unlabelled_audit"] = f"""with b as (select vec_id from ({NAMED}) where category is null)
      select count(*) as n_unlabelled, (select string_agg(vec_id::varchar, ',' order by vec_id) from (select vec_id from b order by vec_id limit 5)) as first_ids from b"""
    o["unseen_labels"] = f"""select label as category, count(*) as n_rows from embeddings where {split_of("vec_id")} <> 'discovery'
      and label not in (select cluster_id from {NAMES}) group by label"""
    o["class_weights"] = """select lang, count(*) as n, round((select count(*) from documents) /
      ((select count(distinct lang) from documents) * count(*)), 6) as weight from documents group by lang"""
    o["misclassified"] = f"""with {NEAREST}, names as (select * from {NAMES})
      select g.vec_id, g.split, d.text as original_text, lower(d.text) as preprocessed_text, a.category as true_category, b.category as predicted_category
      from guess g join names a on a.cluster_id = g.label join names b on b.cluster_id = g.nearest
      left join documents d on d.doc_id = g.vec_id where a.category <> b.category"""
    o["classification_report"] = f"""with {NEAREST}, {REPORT} select split, class, round("precision", 6) as "precision",
      round(recall, 6) as recall, round(f1, 6) as f1, support from rep"""
    o["accuracy_by_split"] = f"""with {NEAREST} select split, count(*) as n_rows, round(avg((label = nearest)::int), 6) as accuracy from guess group by split"""

    # Monitoring
    o["quality_rules"] = f"""with r as (select {blank} <> '' as text_not_blank, length(text) = n_chars as length_matches,
        lang in ('de', 'en', 'es') as known_language, n_chars <= 5000 as short_enough from documents)
      {" union all ".join(f"select {q(c)} as rule, count(*) as n_rows, count(*) filter (not coalesce({c}, false)) as n_failed from r" for c in ("text_not_blank", "length_matches", "known_language", "short_enough"))}"""
    o["null_rates"] = "with j as (select * from documents left join labels using (doc_id)) " + " union all ".join(
        f"select {q(c)} as \"column\", count(*) filter ({c} is null) as n_null, round(count(*) filter ({c} is null) / count(*), 6) as null_rate from j"
        for c in ("text", "lang", "quality", "toxic")
    )
    o["vector_statistics"] = f"with {CENTRES} select (i - 1)::bigint as position, round(avg(x), 6) as mean, round(stddev_samp(x), 6) as stddev from vec group by i"
    o["cluster_spread"] = f"""with {spread} select label, count(*) as n_rows, round(any_value(w) / count(*), 6) as variance
      from embeddings join sq using (label) group by label"""
    o["train_validation_gap"] = f"""with {NEAREST}, {REPORT},
      g as (select class, max(f1) filter (split = 'discovery') as a, max(f1) filter (split = 'validation') as b from rep where split in ('discovery', 'validation') group by class)
      select class, round(a, 6) as f1_train, round(b, 6) as f1_other, round(a - b, 6) as gap from g"""
    o["drift_psi"] = """with e as (select minute(ts) < 30 as early, least(greatest(floor(value / 5), 0), 9)::int as bin from events),
      c as (select bin, count(*) filter (early) as o, count(*) filter (not early) as n from e group by bin),
      s as (select bin, greatest(o / (select sum(o) from c), 1e-6) as so, greatest(n / (select sum(n) from c), 1e-6) as sn from c)
      select bin, round(so, 6) as share_old, round(sn, 6) as share_new, round((sn - so) * ln(sn / so), 6) as psi from s"""
    if english == ("",):
        return {k: v for k, v in o.items() if k not in NEED_STOPWORDS}
    return o
