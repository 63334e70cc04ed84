"""Registered queries of the corpus operators, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import conversations, exact_dedup, html_text, line_dedup, mixing, order_minhash, packing, pieces, simhash, spelling, token_counts, toxicity, url_rules


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_table(spark, sf_dir, "pages"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(_table(spark, sf_dir, "pages"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_decode_digest(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(_table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    demand = mixing.range_sorted(mixing.document_demand(_table(spark, sf_dir, "documents")))
    return demand.select("doc_id", "size", "source_size", "target", "taken", "position")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"), digest_all=True)


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, copies, gone = conversations.damage(_table(spark, sf_dir, "conversations"))
    return conversations.repair_conversations(rows, copies=copies, gone=gone)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.deduplicate_lines(_table(spark, sf_dir, "documents"), least=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"), min_length=6, min_count=5, ratio=5, slip=199)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_fingerprints": op2_fingerprints,
    "op3_toxicity": op3_toxicity,
    "op4_html_text": op4_html_text,
    "op5_packing": op5_packing,
    "op6_url_filters": op6_url_filters,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_simhash": op8_simhash,
    "op9_mixing": op9_mixing,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_conversations": op11_conversations,
    "op12_line_dedup": op12_line_dedup,
    "op13_spelling": op13_spelling,
}

#: crc32 in SQL: a table made from the polynomial, then one step per byte of the text ``{0}``.
_CRC_TABLE = """list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b))"""
_CRC = """xor(list_reduce(list_transform(range(octet_length(encode({0}))), lambda i: ('0x' || substr(hex(encode({0})), (2 * i + 1)::int, 2))::bigint),
          lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::int]), 4294967295), 4294967295)"""


ORACLES: dict[str, str] = {
    "op6_url_filters": r"""
        with parts as (
          select page_id,
            coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
            coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
          from pages),
        ruled as (
          select *, case
            when ('.' || host) like '%.example.net' and starts_with(path, '/en/') then 'example.net/en/'
            when ('.' || host) like '%.example.com' and starts_with(path, '/de/') then 'example.com/de/'
            when ('.' || host) like '%.org' and starts_with(path, '/fr/') then 'org/fr/'
            when ('.' || host) like '%.net' and starts_with(path, '/') then 'net/' end as rule
          from parts)
        -- no page of these tables holds a canonical link or redirect, so nothing propagates
        select page_id, host, path, rule, case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end as verdict from ruled""",
    "op9_mixing": r"""
        with sized as (
          select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size, md5(doc_id::varchar) as h from documents),
        sources as (
          select source, sum(size)::bigint as source_size, ((row_number() over (order by source nulls last) - 1) % 3 + 1)::bigint as w from sized group by source),
        filled as (
          select *, 3 * source_size as cap,
            (sum(source_size) over () - coalesce(sum(3 * source_size) over (order by 3 * source_size / w, source nulls last rows between unbounded preceding and 1 preceding), 0))::bigint as rest,
            (sum(w) over (order by 3 * source_size / w, source nulls last rows between current row and unbounded following))::bigint as free
          from sources),
        level as (select rest::double / free as v from filled where rest * w <= cap * free order by cap / w, source nulls last limit 1),
        targets as (select source, source_size, w, least(cap::double, v * w) as target, floor(least(cap::double, v * w) + 0.5)::bigint as asked from filled, level),
        placed as (
          select s.doc_id, s.size, t.source_size, t.target, t.asked, t.w,
            (sum(s.size) over (partition by s.source order by s.h nulls last, s.doc_id nulls last, s.size rows between unbounded preceding and current row))::bigint - s.size as before,
            case when t.source_size > 0 then t.asked // t.source_size else 0 end as whole
          from sized s join targets t on s.source is not distinct from t.source),
        counted as (select *, (whole * size + greatest(0, least(size, asked - whole * source_size - before)))::bigint as taken from placed),
        -- two steps: the classes ask for all, half and a third of their target in the first
        stepped as (select *, case when w = 1 then target else target * 2 / (2 * w) end as first from counted)
        select doc_id, size, source_size, target, taken,
          case when taken > 0 then case when before::double < first then before::double / first / 2 else (1 + case when target > first then (before::double - first) / (target - first) else 0 end) / 2 end end as position
        from stepped""",
    "op10_exact_dedup": r"""
        with plain as (
          select doc_id, length(coalesce(text, '')) as chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256 from documents)
        select doc_id, first_value(doc_id) over best as keep_id, (count(*) over (partition by text_sha256))::bigint as group_size,
          row_number() over best = 1 as kept, text_sha256
        from plain window best as (partition by text_sha256 order by chars desc, doc_id nulls last)""",
    "op11_conversations": rf"""
        with recursive crc as (select {_CRC_TABLE} as t),
        hashed as (
          select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {_CRC.format("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as how
          from conversations, crc),
        damaged as (
          select conv_id, turn, case when how = 4 then 'user' else role end as role,
            case when how = 1 then '' when how = 2 then translate(text, '.!?', '') else text end as text, unnest(range(case when how = 3 then 2 else 1 end)) as copy
          from hashed where how <> 0),
        placed as (
          select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i,
            row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 as again, substr(role, 1, 1) as init,
            rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as bare
          from damaged),
        judged as (
          select *, case when bare = '' then 1 when again then 2 when right(bare, 1) not in ('.', '!', '?') then 3 else 0 end as fault,
            lag(init) over (partition by conv_id order by i) || init as pair
          from placed),
        counts as (
          select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count(*) filter (fault = 1) as blank,
            count(*) filter (fault = 2) as duplicate, count(*) filter (fault = 3) as truncated, count(*) filter (pair not in ('su', 'ua', 'au')) as illegal, max(i) as last
          from judged group by conv_id),
        -- states 0 to 3: nothing, after system, after user, after assistant; what each asks for and leads to
        states as (select * from (values (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)) v(q, asks, leads)),
        moves as (
          select q, '' as pre, q as p, 0 as c, '' as put from states
          union all select q, 'I', leads, 3, asks || ':' from states),
        edits as (
          select m.q, m.pre || 'R' as edits, s.leads as p, m.c + 3 as c, m.put, s.asks as put_role, null as init from moves m join states s on m.p = s.q
          union all select m.q, m.pre || 'K', k.leads, m.c, m.put, null, k.init
            from moves m join (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)) k(q, init, leads) on m.p = k.q
          union all select q, 'D', q, 4, '', null, null from states),
        dp as (
          select conv_id, 0::bigint as i, 0 as q, row(0, '', []::varchar[]) as b from (select distinct conv_id from conversations)
          union all
          select d.conv_id, d.i + 1, e.p,
            min(row(d.b[1] + e.c + case when r.fault = 3 and e.edits <> 'D' then 3 else 0 end, d.b[2] || e.edits,
              d.b[3] || case when e.put = '' then []::varchar[] else [e.put] end || case when e.edits = 'D' then []::varchar[] else [coalesce(e.put_role, r.role) || ':' || r.text] end))
          from dp d join judged r on d.conv_id is not distinct from r.conv_id and r.i = d.i + 1
            join edits e on e.q = d.q and (e.init is null or e.init = r.init) and (r.fault in (0, 3) or e.edits = 'D')
          group by d.conv_id, d.i, e.p),
        ends as (
          select d.conv_id, row(d.b[1] + t.c, d.b[2] || t.edits, d.b[3] || t.put) as b
          from dp d join (select conv_id, coalesce(last, 0) as last from (select distinct conv_id from conversations) left join counts using (conv_id)) c
            on d.conv_id is not distinct from c.conv_id and d.i = c.last
            join (values (0, 0, '', []::varchar[]), (1, 6, 'II', ['user:', 'assistant:']), (2, 3, 'I', ['assistant:']), (3, 0, '', []::varchar[])) t(q, c, edits, put) on t.q = d.q),
        best as (select conv_id, min(b) as b from ends group by conv_id)
        select b.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
          coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, b.b[1]::bigint as cost, b.b[2] as audit,
          sha256(array_to_string(b.b[3], chr(10))) as repaired_sha256
        from best b left join counts c on b.conv_id is not distinct from c.conv_id""",
    "op12_line_dedup": r"""
        with rows as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
        lines as (
          select r, doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
          from (select r, doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as i from rows)),
        shared as (
          select key, min(doc_id) as first_doc from lines where length(key) >= 10 group by key
          having count(distinct doc_id) + max((doc_id is null)::int) >= 2),
        judged as (select lines.*, shared.key is not null and lines.doc_id is distinct from first_doc as gone from lines left join shared using (key))
        select any_value(doc_id) as doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
          sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
        from judged group by r""",
    "op13_spelling": rf"""
        with recursive crc as (select {_CRC_TABLE} as t),
        runs as (
          select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) as run from documents),
        lowered as (select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n from runs group by all),
        hashed as (select run, n, {_CRC.format("coalesce(doc_id::varchar, '') || ':' || run")} as h from lowered, crc),
        slipped as (
          select case when h % 199 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run) + 2)::int) else run end as word, n from hashed),
        words as (select word, sum(n)::bigint as n from slipped where length(word) >= 6 group by word having sum(n) >= 5),
        spots as (select word, unnest(range(length(word)))::int as i from words),
        cut as (select word, substr(word, 1, i) || substr(word, i + 2) as short, substr(word, 1, i) || '*' || substr(word, i + 2) as hole from spots),
        pairs as (
          select cut.word, w.word as near from cut join words w on cut.short = w.word
          union select w.word, cut.word from cut join words w on cut.short = w.word
          union select a.word, b.word from cut a join cut b on a.hole = b.hole where a.word <> b.word),
        near as (
          select p.word, count(*)::bigint as n_near, arg_min(p.near, row(-w.n, p.near)) as best, max(w.n) as best_n
          from pairs p join words w on p.near = w.word group by p.word),
        formed as (
          select words.word, words.n, coalesce(n_near, 0)::bigint as n_near,
            case when best_n >= 5 * words.n then best end as form, case when best_n >= 5 * words.n then best_n end as form_n
          from words left join near using (word)),
        chain as (
          select word, word as root, form as next from formed
          union all select c.word, c.next, f.form from chain c join formed f on c.next = f.word where c.next is not null)
        select f.word, f.n, f.n_near, f.form, f.form_n, c.root from formed f join chain c on f.word = c.word where c.next is null""",
}
