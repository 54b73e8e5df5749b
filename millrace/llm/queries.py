"""The queries of this subpackage: thin digests of what its operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import chat, embeddings, fingerprints, langid, lines, ngram_join, packing, pieces, spelling, substring_dedup, suffix_dedup, urls, whitening

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def public_tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizer("word_bpe_49k.json"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_copies(table(spark, sf_dir, "documents"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_byte_digests(table(spark, sf_dir, "documents"))


#: Fixed by the contract of op5.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), URL_RULES)


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2


#: Texts whose languages are closer than this are rejected (but no exact ties), as are those without a letter.
MIN_MARGIN = 0.002


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~held_out()))
    found = langid.predict(docs, model, MIN_MARGIN)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digests(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trips(table(spark, sf_dir, "documents"), public_tokenizer("piece_bpe_32k.model"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_word_digests(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


#: Fixed by the contract of op13: control strings inside texts.
PLANTED = [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(PLANTED, "conv_id long, turn long, role string, text string")
    found = chat.format_conversations(chat.thread(rows.unionByName(planted)))
    return chat.digests(found).withColumnRenamed("tree", "conv_id")


QUERIES: dict[str, Query] = {
    "op1_document_fingerprints": op1_document_fingerprints,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_url_filters": op5_url_filters,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_language_id": op7_language_id,
    "op8_line_dedup": op8_line_dedup,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_chat_formatting": op13_chat_formatting,
}

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

ORACLES: dict[str, str] = {
    "op3_ngram_jaccard_join": f"""
        with recursive words as (select doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} as w from documents),
        shingles as (
            select distinct doc_id, md5(array_to_string(w[p : p + 4], ' ')) as s
            from words, unnest(generate_series(1, greatest(len(w) - 4, 1))) as g(p) where len(w) > 0
        ),
        sizes as (select doc_id, count(*) as n from shingles group by doc_id),
        shared as (
            select a.doc_id as u, b.doc_id as v, count(*) as k
            from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2
        ),
        links as (
            select u, v from shared join sizes a on a.doc_id = u join sizes b on b.doc_id = v
            where 100 * k >= 80 * (a.n + b.n - k)
        ),
        reached as (select doc_id, doc_id as other from documents union select r.doc_id, v from reached r join links on u = r.other)
        select d.doc_id, coalesce(any_value(n), 0) as n_shingles, min(other) as component_id
        from documents d left join sizes s on s.doc_id = d.doc_id join reached r on r.doc_id = d.doc_id group by d.doc_id
    """,
    "op4_suffix_array_dedup": """
        with raw as (select doc_id, encode(coalesce(text, '')) as b from documents),
        spots as (
            select doc_id, p, md5(b[p : p + 399]) as h
            from raw, unnest(generate_series(1, octet_length(b) - 399)) as g(p)
        ),
        repeated as (select doc_id, p from (select *, count(*) over (partition by h) as k from spots) where k > 1),
        steps as (select *, p - lag(p) over (partition by doc_id order by p) as gap from repeated),
        runs as (select *, count(*) filter (where gap is null or gap > 400) over (partition by doc_id order by p) as run from steps),
        spans as (select doc_id, run, min(p) as low, max(p) + 400 as high from runs group by doc_id, run),
        ends as (select doc_id, list(low order by run) as lows, list(high order by run) as highs from spans group by doc_id),
        kept as (
            select r.doc_id, b, coalesce(lows, []) as lows, coalesce(highs, []) as highs
            from raw r left join ends e on e.doc_id = r.doc_id
        )
        select doc_id, octet_length(b) as n_bytes,
               coalesce(list_sum(highs), 0)::bigint - coalesce(list_sum(lows), 0)::bigint as n_removed, len(lows) as n_spans,
               sha256(from_hex(array_to_string(list_transform(generate_series(0, len(lows)),
                   lambda i: hex(b[coalesce(highs[i], 1) : coalesce(lows[i + 1], octet_length(b) + 1) - 1])), ''))) as kept_sha256
        from kept
    """,
    "op10_substring_dedup": f"""
        with texts as (select doc_id, {_WORDS.format("coalesce(text, '')")} as w from documents),
        windows as (
            select doc_id, p, md5(array_to_string(w[p : p + 19], ' ')) as h
            from texts, unnest(generate_series(1, len(w) - 19)) as g(p)
        ),
        again as (
            select doc_id, p from (select *, row_number() over (partition by h order by doc_id, p) as k from windows) where k > 1
        ),
        words as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i from texts),
        last as (
            select w.*, max(p) over (partition by w.doc_id order by i) as top
            from words w left join again a on a.doc_id = w.doc_id and p = i
        ),
        marked as (select *, coalesce(i - top < 20, false) as gone from last)
        select t.doc_id, count(i) as n_words, count(i) filter (where gone) as n_removed,
               sha256(coalesce(string_agg(word, ' ' order by i) filter (where not gone), '')) as kept_sha256
        from texts t left join marked m on m.doc_id = t.doc_id group by t.doc_id
    """,
    "op8_line_dedup": f"""
        with parts as (select doc_id, string_split(coalesce(text, ''), chr(10)) as p from documents),
        lines as (select doc_id, unnest(p) as line, generate_subscripts(p, 1) as i from parts),
        keyed as (select *, translate(trim(line, {_SPACE}), '{_UPPER}', '{_LOWER}') as key from lines),
        common as (
            select key, max(doc_id) as top from keyed where length(key) >= 40
            group by key having count(distinct doc_id) >= 5
        ),
        marked as (
            select k.doc_id, k.line, k.i, c.key is not null and k.doc_id < c.top as gone
            from keyed k left join common c on k.key = c.key
        )
        select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
        from marked group by doc_id
    """,
    "op12_spelling_variants": f"""
        with recursive crc0 as (select i, i as c, 0 as k from range(256) t(i) union all
            select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from crc0 where k < 8),
        tab as (select list(c order by i) as t from crc0 where k = 8),
        runs as (
            select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), '{_UPPER}', '{_LOWER}') as low
            from documents
        ),
        long as (select doc_id, low, count(*) as k from runs where length(low) >= 7 group by doc_id, low),
        bytes as (select doc_id, low, k, hex(encode(doc_id::varchar || ':' || low)) as x from long),
        hashed as (
            select doc_id, low, k, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(x) // 2), lambda i: ('0x' || x[2 * i + 1 : 2 * i + 2])::bigint)),
                lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295) as h
            from bytes, tab
        ),
        cut as (
            select k, case when h % 31 = 0 then low[: h % length(low)] || low[h % length(low) + 2 :] else low end as word from hashed
        ),
        words as (select word, sum(k)::bigint as n from cut where length(word) >= 7 group by word having sum(k) >= 2),
        spots as (select word, n, unnest(range(length(word))) as i from words),
        less as (select distinct word, n, word[: i] || word[i + 2 :] as rest from spots),
        open as (select word, n, i, word[: i] || word[i + 2 :] as rest from spots),
        pairs as (
            select a.word, b.word as other, b.n as m from less a join words b on a.rest = b.word
            union all select b.word, a.word, a.n from less a join words b on a.rest = b.word
            union all select a.word, b.word, b.n from open a join open b on a.rest = b.rest and a.i = b.i and a.word <> b.word
        ),
        near as (select word, count(*) as n_near, max(m) as m, arg_min(other, (-m, encode(other))) as best from pairs group by word),
        formed as (
            select w.word, case when m >= 10 * n then best end as form, n, coalesce(n_near, 0) as n_near, case when m >= 10 * n then m end as form_n
            from words w left join near using (word)
        ),
        chain as (select word, word as reached, 0 as step from formed union all
            select c.word, f.form, step + 1 from chain c join formed f on f.word = c.reached where f.form is not null),
        ends as (select word, arg_max(reached, step) as root from chain group by word)
        select word, form, root, n, n_near, form_n from formed join ends using (word)
    """,
    "op13_chat_formatting": """
        with said as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select * from (values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
        ),
        marks as (select ['<s>', '</s>', '[SYS]', '[/SYS]', '[INST]', '[/INST]', '[ROLE]', '[/ROLE]', '[NAME]'] as m),
        sized as (
            select *, length(replace(text, chr(92), chr(92) || chr(92)))
                + list_sum(list_transform(m, lambda x: (length(text) - length(replace(text, x, ''))) // length(x)))::bigint as body,
                case role when 'user' then 15 when 'system' then 13 when 'assistant' then 9 else 23 + length(role) end as around
            from said, marks
        )
        select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
               coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
               sum(body + around)::bigint as formatted_chars
        from sized group by conv_id
    """,
}
