"""Queries of the operators, each over the whole of its table, and their SQL counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import (
    chat, collisions, cotraining, licenses, mixing, near_dup, quality_rules, repair, runs, small_batches,
)
from tidemill.llm.packing import pack_documents
from tidemill.llm.token_store import read_tokens, train_dictionary, write_tokens
from tidemill.llm.topk import top_k
from tidemill.llm.wordpiece import count_pieces
from tidemill.session import shared_folder

TOKEN_BATCH = 2500  # distinct chunks are encoded once per batch
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def _table(spark: SparkSession, folder: str, name: str, batch: int = 1000) -> DataFrame:
    return small_batches(spark, batch).read.parquet(f"{folder}/{name}.parquet")


def op1_token_store(spark: SparkSession, folder: str) -> DataFrame:
    docs, path = _table(spark, folder, "documents", TOKEN_BATCH), shared_folder(spark, "tokens")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    dictionary = train_dictionary(docs, tokenizer, "space")
    write_tokens(docs, path, tokenizer, "space", end_id=0, dictionary=dictionary)
    return read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_pieces(
        _table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    # Documents stand in for files: source, language and ranges of ids are their directories, at
    # four depths.
    path = F.expr(
        "concat(array_join(slice(array(coalesce(source, '-'), coalesce(lang, '-'),"
        " cast(doc_id div 4000 as string), cast(doc_id div 200 as string)), 1,"
        " cast(1 + pmod(doc_id, 4) as int)), '/'), '/', cast(doc_id as string), '.txt')"
    )
    files = _table(spark, folder, "documents").select(path.alias("path"), "text")
    doc_id = F.regexp_extract("path", r"(-?\d+)\.txt$", 1).cast("long")
    return licenses.scan(files).select(
        doc_id.alias("doc_id"), "own", "score", "n_licenses", "inherited", "from_directory", "license"
    )


def op3_license_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every fortieth document stands for a licence file: a licence's text, and after it its own."""
    texts = licenses.full_texts()
    directory = F.expr("concat(coalesce(source, '-'), '/', cast(doc_id div 200 as string), '/')")
    named = F.pmod("doc_id", F.lit(40)) == 0
    texts = F.array(*map(F.lit, texts.values()))
    licence = F.element_at(texts, (F.pmod(F.col("doc_id") / 40, F.size(texts)) + 1).cast("int"))
    files = _table(spark, folder, "documents").select(
        F.concat(
            directory, F.when(named, F.concat(F.lit("LICENSE-"), "doc_id")).otherwise(F.concat("doc_id", F.lit(".txt")))
        ).alias("path"),
        F.when(named, F.concat(licence, F.lit("\n\n"), F.coalesce("text", F.lit(""))))
        .otherwise(F.col("text")).alias("text"),
    )
    return licenses.scan(files)


def op4_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 100 = 0"), 10).select(
        "query_id", "rank", "vec_id", "score"
    )


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = pack_documents(
        _table(spark, folder, "documents", TOKEN_BATCH), public_tokenizers.path("word_bpe_49k.json"), "white",
        end_id=2, capacity=4096,
    )
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.grouped(_table(spark, folder, "documents"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """A row per document and epoch, with the turn of its block in that epoch's permutation."""
    rows = mixing.epochs_of(_table(spark, folder, "documents"), ["doc_id"], entropy=0.5)
    return rows.select(
        "row.doc_id", "source", "n_tokens", "block", F.round("weight", 9).alias("weight"), "epochs", "copies",
        "epoch", "turn",
    )


def op7_mixed_order(spark: SparkSession, folder: str) -> DataFrame:
    """The mix of `op7_mixing` in its order: a row per document and epoch."""
    rows = mixing.epochs_of(_table(spark, folder, "documents"), ["doc_id"], entropy=0.5)
    return rows.orderBy(*mixing.ORDER).select("row.doc_id", "source", "block", "epoch", "turn", "at")


def op8_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = F.explode(F.array(*[
        F.struct(F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"))
        for i, role in enumerate(("user", "assistant"))
    ]))
    added = spark.range(1).select(control.alias("t")).select(
        F.lit(-1).cast("long").alias("conv_id"), "t.turn", "t.role", F.lit(CONTROL_TEXT).alias("text")
    )
    written_turns = chat.format_turns(rows.unionByName(added))
    read = chat.read_turns(written_turns)
    # A digest needs its whole conversation, so that the texts of one are gathered here, and only here.
    turns = F.array_sort(F.collect_list(F.struct("place", "role", "text", "loss")))
    whole = read.groupBy("conv_id").agg(
        turns.alias("turns"), F.sum("chars").cast("long").alias("formatted_chars"),
        F.bool_and(F.col("legal") & (~F.col("last") | F.col("ends"))).alias("in_order"),
    )
    spelt = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t.loss), lambda t: t.text), "")
    return whole.select("*", loss.alias("loss")).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(spelt, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars", "in_order",
    )


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    return cotraining.classify(docs, labels, ["doc_id"], beside=True).select("row.doc_id", "score", "kept")


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(_table(spark, folder, "documents"), ["doc_id"]).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op11_vector_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return collisions.linked(_table(spark, folder, "embeddings"))


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; in every tenth text, by a checksum of the id, words repeat from some word on."""
    words = F.array_remove(F.split(F.translate(F.coalesce("text", F.lit("")), mixing.WHITE, " " * 6), " "), "")
    g = F.floor(F.crc32(F.col("doc_id").cast("string")) / 10)
    chosen = (F.crc32(F.col("doc_id").cast("string")) % 10 == 0) & (F.size("words") > 0)
    n = F.size("words")
    first = (g % n).cast("int")
    period = (1 + F.floor((n - F.col("first")) / (3 + g % 8))).cast("int")
    repeated = F.concat(
        F.slice("words", 1, F.col("first")),
        F.transform(
            F.sequence(F.lit(0), n - F.col("first") - 1),
            lambda i: F.get("words", F.col("first") + i % F.col("period")),
        ),
    )
    cut = docs.select("doc_id", "text", words.alias("words")).select("*", F.when(chosen, first).alias("first"))
    return cut.select("*", period.alias("period")).select(
        "doc_id", F.when(F.col("first").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text")
    )


def op12_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.find_runs(with_periods(_table(spark, folder, "documents")))
    longest = F.element_at(
        F.array_sort(F.transform("runs", lambda r: F.struct((-r.length).alias("l"), r.start.alias("s"), r.period.alias("p")))), 1
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.select("*", F.when(F.size("runs") > 0, longest).alias("best")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.s").alias("start"),
        (-F.col("best.l")).alias("length"), F.col("best.p").alias("period"),
        F.expr("-1000 * best.l div best.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults, chosen by a checksum of conversation and turn."""
    space = F.lit(" ")
    key = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    draw = F.crc32(F.concat(key[0], F.lit(":"), key[1])) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return rows.select("conv_id", "turn", "role", "text", draw.alias("draw")).where("draw <> 0").select(
        "conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations")
    edits, reports = repair.repair(damaged(rows))
    digests = repair.digests(edits)
    all_ids = rows.select("conv_id").distinct()
    report = all_ids.join(reports.withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    whole = report.join(digests.withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of")), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return whole.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


QUERIES = {
    "op1_token_store": op1_token_store,
    "op2_token_counts": op2_token_counts,
    "op3_licenses": op3_licenses,
    "op3_license_files": op3_license_files,
    "op4_top_k": op4_top_k,
    "op5_packing": op5_packing,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_mixing": op7_mixing,
    "op7_mixed_order": op7_mixed_order,
    "op8_chat_format": op8_chat_format,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_quality_rules": op10_quality_rules,
    "op11_vector_duplicates": op11_vector_duplicates,
    "op12_runs": op12_runs,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES = {
    "op3_licenses": r"""
        with docs as (
            select row_number() over () as rid, doc_id, coalesce(text, '') as text,
                array_to_string(list_slice([coalesce(source, '-'), coalesce(lang, '-'), (doc_id // 4000)::varchar,
                    (doc_id // 200)::varchar], 1, 1 + doc_id % 4), '/') as directory
            from documents where doc_id is not null
        ),
        templates(license, line) as (values
            ('Apache-2.0', 'licensed under the apache license version 2 0'),
            ('BSD-3-Clause', 'licensed under the bsd 3 clause license'),
            ('CC-BY-4.0', 'this work is licensed under cc by 4 0'),
            ('CC-BY-NC-4.0', 'licensed under cc by nc 4 0'),
            ('CC-BY-SA-4.0', 'this work is licensed under cc by sa 4 0'),
            ('GPL-2.0', 'this work is licensed under the gnu general public license version 2'),
            ('GPL-3.0', 'this work is licensed under the gnu general public license version 3'),
            ('LGPL-3.0', 'licensed under the gnu lesser general public license version 3'),
            ('MIT', 'released under the mit license'),
            ('MPL-2.0', 'subject to the terms of the mozilla public license version 2 0')
        ),
        parts as (select license, word, count(*) as c from (select license, unnest(string_split(line, ' ')) as word from templates) group by all),
        words as (select distinct word from parts),
        lines as (
            select rid, directory, row_number() over () as line,
                regexp_extract_all(lower(line), '[^] .,;:!?()[{}<>"''`/\\|*#%&$@+=_~^\t\r\x0b\f\n-]+') as terms
            from (select rid, directory, unnest(string_split(text, chr(10))) as line from docs)
        ),
        total as (select count(*) as n from docs),
        frequency as (select word, count(distinct rid) as d from (select rid, unnest(terms) as word from lines) semi join words using (word) group by word),
        weights as (select word, ln((1 + n) / (1 + coalesce(d, 0))) + 1 as idf from words cross join total left join frequency using (word)),
        vectors as (
            select license, word, c * idf / sqrt(sum(c * idf * c * idf) over (partition by license)) as part
            from parts join weights using (word)
        ),
        cued as (select * from lines where list_has_any(terms, (select list(word) from words))),
        counted as (select rid, line, word, count(*) as c from (select rid, line, unnest(terms) as word from cued) group by all),
        weighed as (select rid, line, word, c * coalesce(idf, ln(1 + n) + 1) as w from counted cross join total left join weights using (word)),
        norms as (select rid, line, sqrt(sum(w * w)) as norm from weighed group by all),
        scores as (
            select rid, line, license, round(sum(w * part) / any_value(norm), 6) as score
            from weighed join vectors using (word) join norms using (rid, line) group by all
        ),
        units as (
            select * from scores where score >= 0.75
            qualify row_number() over (partition by rid, line order by score desc, license) = 1
        ),
        own as (
            select rid, count(distinct license) as n_licenses, max(score) as score,
                arg_min(license, (-score, license)) as own
            from units group by rid
        ),
        votes as (select directory, own as license, count(*) as n from own join docs using (rid) group by all),
        governing as (select directory, license from votes qualify row_number() over (partition by directory order by n desc, license) = 1),
        nearest as (
            select d.directory, arg_max(g.license, length(g.directory)) as inherited, arg_max(g.directory, length(g.directory)) as from_directory
            from (select distinct directory from docs) d join governing g
                on d.directory = g.directory or starts_with(d.directory, g.directory || '/')
            group by d.directory
        )
        select doc_id, own, score, coalesce(n_licenses, 0) as n_licenses,
            case when own is null then inherited end as inherited,
            case when own is null then from_directory end as from_directory, coalesce(own, inherited) as license
        from docs left join own using (rid) left join nearest using (directory)
    """,
    "op4_top_k": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as e
            from embeddings
            where vec_id is not null and embedding is not null
                and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
        ),
        pairs as (
            select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.e, c.e) as bigint) as score
            from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 100 = 0
        )
        select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank,
            vec_id, score
        from pairs qualify rank <= 10
    """,
    "op6_near_duplicates": r"""
        with recursive words as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
        ),
        sets as (
            select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
                else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
            from words
        ),
        sizes as (select doc_id, count(*) as n from sets group by doc_id),
        pairs as (
            select a.doc_id as x, b.doc_id as y, count(*) as shared
            from sets a join sets b on a.s = b.s and a.doc_id < b.doc_id group by all
        ),
        links as (
            select x, y from pairs join sizes a on a.doc_id = x join sizes b on b.doc_id = y
            where 100 * shared >= 75 * (a.n + b.n - shared)
        ),
        ways as (select x, y from links union all select y, x from links),
        reach as (
            select doc_id, doc_id as other from words
            union
            select r.doc_id, ways.y from reach r join ways on ways.x = r.other
        ),
        least as (select doc_id, min(other) as component_id from reach group by doc_id)
        select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept
        from least left join sizes using (doc_id)
    """,
    "op7_mixing": r"""
        with docs as (
            select row_number() over () as rid, doc_id, source,
                cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as n_tokens,
                cast('0x' || substr(md5('7/' || doc_id || '/' || md5(coalesce(text, ''))), 1, 15) as bigint) as draw
            from documents
        ),
        shares as (
            select source, tokens, tokens / sum(tokens) over () as share
            from (select source, cast(sum(n_tokens) as bigint) as tokens from docs group by source) where tokens > 0
        ),
        grid as (select unnest(range(0, 10001)) / 10000 as a),
        entropies as (
            select a, ln(sum(exp(a * ln(share)))) - a * sum(exp(a * ln(share)) * ln(share)) / sum(exp(a * ln(share))) as h
            from grid, shares group by a
        ),
        chosen as (
            select min(a) as a from entropies
            where h <= (select h from entropies where a = 1) + 0.5 * ((select h from entropies where a = 0) - (select h from entropies where a = 1))
        ),
        raw as (select source, tokens, share, exp(a * ln(share)) as r from shares, chosen),
        plan as (
            select source, tokens, r / norm as weight, cast(round(total * rarest * norm * r / norm) as bigint) as budget
            from raw, (select sum(r) as norm, sum(tokens) as total, max(share / r) as rarest from raw)
        ),
        epochs as (select *, budget // tokens as epochs, budget % tokens as left_over, tokens // 1048576 + 1 as blocks from plan),
        dealt as (
            select rid, doc_id, d.source, n_tokens, draw, weight, epochs, left_over, (draw >> 20) % coalesce(blocks, 1) as block
            from docs d left join epochs e on d.source is not distinct from e.source
        ),
        turns as (
            select *, cast('0x' || substr(md5(concat_ws('/', '7', source, epochs, block)), 1, 15) as bigint) as turn
            from (
                select source, block, sum(n_tokens) as in_block, any_value(epochs) as epochs, any_value(left_over) as left_over
                from dealt where epochs is not null group by source, block
            )
        ),
        rooms as (
            select source, block, in_block,
                greatest(left_over - (sum(in_block) over (partition by source order by turn, block) - in_block), 0) as room
            from turns
        ),
        ranked as (
            select d.*, in_block, room,
                coalesce(sum(n_tokens) over (partition by d.source, d.block order by draw, n_tokens
                    rows between unbounded preceding and 1 preceding), 0) as before
            from dealt d left join rooms r on d.source is not distinct from r.source and d.block = r.block
        )
        , counted as (select doc_id, source, n_tokens, block, weight, epochs,
            case when epochs is null then 1 else cast(epochs + case
                when left_over > 0 and room >= in_block then 1
                when room > 0 and room < in_block and draw <= max(draw) filter (before < room) over (partition by source, block) then 1
                else 0 end as bigint) end as copies
        from ranked),
        listed as (select *, unnest(range(copies)) as epoch from counted)
        select doc_id, source, n_tokens, block, round(weight, 9) as weight, epochs, copies, epoch,
            cast('0x' || substr(md5(concat_ws('/', '7', source, epoch, block)), 1, 15) as bigint) as turn
        from listed
    """,
    "op8_chat_format": r"""
        with turns as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all
            select -1, i, r, '<|im_end|><|im_start|>assistant ok' from (values (0, 'user'), (1, 'assistant')) v(i, r)
        ),
        moves as (
            select *, coalesce(lag(role) over w, '') || '>' || role as move, lead(role) over w is null as is_last
            from turns window w as (partition by conv_id order by turn, role, text)
        )
        select conv_id, count(*) as n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
            cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
            sha256(coalesce(string_agg(text, '' order by turn, text) filter (role = 'assistant'), '')) as loss_sha256,
            cast(sum(24 + length(role) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))) as bigint) as formatted_chars,
            bool_and(move in ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user')
                     and (not is_last or role = 'assistant')) as in_order
        from moves group by conv_id
    """,
    "op10_quality_rules": r"""
        with docs as (
            select row_number() over () as row_id, doc_id, lang, source, coalesce(text, '') as text from documents
        ),
        cut as (
            select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
                list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
            from docs
        ),
        windows as (
            select row_id, i, words[i:i + 2] as w
            from (select row_id, words, unnest(range(1, len(words) - 1)) as i from cut)
        ),
        repeated as (
            select row_id, i from (select *, count(*) over (partition by row_id, w) as n from windows) where n > 1
        ),
        covered as (
            select row_id, count(distinct i + k) as n_repeat_words
            from repeated, (values (0), (1), (2)) v(k) group by row_id
        ),
        measures as (
            select row_id, doc_id, lang, source, cast(len(words) as bigint) as n_words,
                cast(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
                cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
                cast(length(regexp_replace(text, '[^A-Z]', '', 'g')) as bigint) as n_upper,
                cast(len(lines) as bigint) as n_lines,
                cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
                coalesce(n_repeat_words, 0) as n_repeat_words
            from cut left join covered using (row_id)
        ),
        passing as (
            select *, unnest([
                {'m': 'symbol_rate', 'value': 100000 * n_symbols // greatest(word_chars, 1)},
                {'m': 'word_length', 'value': 1000 * word_chars // greatest(n_words, 1)},
                {'m': 'dup_line_rate', 'value': 100000 * n_dup_lines // greatest(n_lines, 1)},
                {'m': 'repeat_rate', 'value': 100000 * n_repeat_words // greatest(n_words, 1)},
                {'m': 'upper_rate', 'value': 100000 * n_upper // greatest(word_chars, 1)},
                {'m': 'word_chars', 'value': word_chars}, {'m': 'n_words', 'value': n_words},
                {'m': 'n_lines', 'value': n_lines}
            ], recursive := true) from measures where not (n_words < 50 or 100 * n_repeat_words > 50 * n_words)
        ),
        binned as (
            select lang, source, m, (value >> more) << more as bin, count(*) as n
            from (select *, greatest(length(bin(value)) - 8, 0)::bigint as more from passing) group by all
        ),
        totals as (select m, sum(n) as total from binned group by m),
        merged as (
            select lang, source, true as own, m, bin, sum(w) as w from (
                select lang, source, m, bin, n * total as w from binned join totals using (m)
                union all
                select g.lang, g.source, b.m, b.bin, 200 * b.n
                from (select distinct lang, source from binned) g, binned b
            ) group by all
            union all
            select null, null, false, m, bin, sum(n) from binned group by m, bin
        ),
        ranked as (
            select *, sum(w) over (partition by own, lang, source, m order by bin) as upto,
                sum(w) over (partition by own, lang, source, m) as every from merged
        ),
        quartiles as (
            select own, lang, source, m, min(bin) filter (4 * upto >= every) as low,
                min(bin) filter (4 * upto >= 3 * every) as high
            from ranked group by all
        ),
        rules(m, size, per, quarter) as (values
            ('symbol_rate', 'word_chars', 100000, 1), ('word_length', 'n_words', 0, 1), ('dup_line_rate', 'n_lines', 100000, 3),
            ('repeat_rate', 'n_words', 600000, 1), ('upper_rate', 'word_chars', 100000, 1)
        ),
        fences as (
            select q.own, q.lang, q.source, q.m, q.high,
                q.high + 9 * greatest(q.high - q.low, per // greatest(case quarter when 1 then z.low else z.high end, 1), 1) as fence
            from quartiles q join rules using (m) join quartiles z on z.m = rules.size and z.own = q.own
                and z.lang is not distinct from q.lang and z.source is not distinct from q.source
        ),
        most as (
            select g.lang, g.source, g.m, least(g.fence, 2 * t.fence - t.high) as fence
            from fences g join fences t on g.m = t.m and g.own and not t.own
        ),
        beyond as (
            select row_id, bool_or(value > fence) as over
            from passing p join most f on p.m = f.m
                and p.lang is not distinct from f.lang and p.source is not distinct from f.source
            group by row_id
        )
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
            (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed,
            coalesce(not over, false) as kept
        from measures left join beyond using (row_id)
    """,
    "op11_vector_duplicates": """
        with recursive v as (
            select row_number() over () as rid, vec_id, label, list_transform(embedding, lambda x: x::double) as e
            from embeddings
        ),
        fine as (
            select rid, vec_id, label, len(e) as dim, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) as u
            from v where label is not null and vec_id is not null and e is not null
                and len(list_filter(e, lambda x: x is null or isnan(x) or isinf(x))) = 0 and list_dot_product(e, e) > 0
        ),
        links as (
            select a.rid as x, b.rid as y from fine a join fine b on a.label = b.label and a.dim = b.dim and a.rid <> b.rid
            where list_dot_product(a.u, b.u) >= 0.93
        ),
        reach as (
            select rid, rid as other from v
            union
            select r.rid, links.y from reach r join links on links.x = r.other
        ),
        least as (select r.rid, min(o.vec_id) as component_id from reach r join v o on o.rid = r.other group by r.rid),
        counts as (select x as rid, count(*) as n from links group by x)
        select vec_id, coalesce(n, 0) as n_links, component_id, vec_id is not distinct from component_id as kept
        from v join least using (rid) left join counts using (rid)
    """,
}
