"""The registered queries of this subpackage and their DuckDB counterparts.

Each query applies one operator, with production parameters, to the whole of its table and takes
the columns that it returns from the operator's output.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import (
    bpe,
    chat,
    collocations,
    decontamination,
    fingerprints,
    lines,
    merkle,
    mixing,
    pii,
    sharding,
    simhash,
    tokens,
    toxicity,
)
from feedloom.llm.common import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.fingerprint_documents(documents(spark, sf_dir))
    own, new, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_text(own).alias("fingerprint"),
        fingerprints.as_text(new).alias("edited_fingerprint"),
        fingerprints.containment(own, new).alias("near_edited"),
        fingerprints.containment(own, following).alias("near_next"),
        fingerprints.resemblance(own, new).alias("jaccard_edited"),
        fingerprints.resemblance(own, following).alias("jaccard_next"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shuffle_into_shards(documents(spark, sf_dir).select("doc_id", "text"), 24, seed=2)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 8
    return placed.select(
        "doc_id", size.alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_contained(
        documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), least=0.8)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(documents(spark, sf_dir).select("doc_id", "text"))
    counts = [
        F.size(pii.of_kind("base_spans", i)).cast("bigint").alias(f"n_{kind}")
        for i, kind in enumerate(pii.KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(pii.as_text("base_spans").cast("binary"), 256).alias("base_sha256"),
        pii.as_text("spans").alias("spans"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_documents(
        documents(spark, sf_dir).select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.remove_boilerplate(
        documents(spark, sf_dir).select("doc_id", "text", "source"), least_sites=10)
    return kept.select(
        "doc_id", "n_lines", "n_removed", F.length("text").cast("bigint").alias("kept_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), length=3, bits=3)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def mix_weight(place: int) -> float:
    """Sources in order weigh 5, 2, 1, 5, 2, 1 and so on."""
    return (5, 2, 1)[place % 3]


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir), mix_weight, share=1.5, cap=2, seed=8)
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).alias("taken"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.count_tokens(
        documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), 2048)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def read_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digests of what the formatted text and its mask hold."""
    for batch in batches:
        out = []
        for row in batch.itertuples():
            turns = chat.parse(row.formatted)
            loss = chat.trained_text(row.formatted, row.loss_mask, row.loss_from, row.loss_to)
            whole = "".join(f"{role}\n{text}\n" for role, text in turns)
            out.append((row.conv_id, len(turns), digest(whole), len(loss), digest(loss),
                        len(row.formatted)))
        yield pd.DataFrame(out, columns=[
            "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)],
        "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat.format_conversations(
        rows.unionByName(extra), public_tokenizers.path("byte_bpe_50k.json"))
    return formatted.mapInPandas(
        read_back, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    changed = merkle.leaf(*[F.col(f) for f in fields[:-1]], lowered)
    rows = merkle.manifest(
        documents(spark, sf_dir), "lang", "doc_id", fields,
        F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, changed))
    return rows.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(
        documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id", "n_tokens", F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(documents(spark, sf_dir), least=30, longest=4, covered=80, top=2000)


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_sharding": op2_sharding,
    "op3_decontamination": op3_decontamination,
    "op4_pii": op4_pii,
    "op5_toxicity": op5_toxicity,
    "op6_line_dedup": op6_line_dedup,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_mixing": op8_mixing,
    "op9_token_counts": op9_token_counts,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_bpe": op12_bpe,
    "op13_phrase_mining": op13_phrase_mining,
}

WORDS = """
    list_filter(string_split_regex(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"""

#: A shingle is five words, or the whole of a shorter text.
SHINGLES = """
    case when len(w) > 0 then list_distinct(list_transform(range(greatest(len(w) - 5, 0) + 1),
      lambda i: array_to_string(w[i + 1:i + 5], ' '))) else [] end"""

BARE_LINE = r"trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"

def field(name: str) -> str:
    return f"coalesce(strlen(cast({name} as varchar)) || ':' || cast({name} as varchar), '-')"


def leaf_sql(text: str) -> str:
    return f"sha256({' || '.join(map(field, ['doc_id', 'source', 'lang', 'n_chars', text]))})"


LOWERED = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def climb_sql(name: str, nodes: str) -> str:
    """The nodes of all levels over ``nodes`` (g, pos, h, n), the last level being the group's top."""
    return f"""
        {name} as (select g, 0 as lvl, pos, h, n from {nodes}
          union all
          select g, lvl + 1, pos // 8, sha256(string_agg(h, '' order by pos)), max((n + 7) // 8)
          from {name} where n > 1 group by g, lvl, pos // 8)"""


def siblings_sql(nodes: str) -> str:
    return f"""
        select b.g, b.lvl, b.pos, coalesce(string_agg(s.h, '' order by s.pos) filter (s.pos < b.pos), '') as l,
          coalesce(string_agg(s.h, '' order by s.pos) filter (s.pos > b.pos), '') as r
        from {nodes} b join {nodes} s on b.g = s.g and b.lvl = s.lvl and b.pos // 8 = s.pos // 8
        where b.n > 1 group by all"""


#: CRC-32 of the decimal text of doc_id, bit by bit.
CRC = """
    xor(4294967295, list_reduce([4294967295] || list_transform(range(1, length(cast(doc_id as varchar)) + 1),
        lambda i: cast(ascii(substr(cast(doc_id as varchar), i, 1)) as bigint)),
      lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))))"""

ORACLES: dict[str, str] = {
    "op13_phrase_mining": f"""
        with p as (select coalesce(lang, 'und') as lang,
            list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') as w
          from (select lang, unnest(string_split_regex({LOWERED}, '[.,;:!?\\x0A-\\x0D]')) as piece from documents) x),
        o as (select lang, w, unnest(range(1, len(w) + 1)) as i from p),
        g as (select lang, k, w[i:i + k - 1] as g, count(*) as f from o, range(1, 5) t(k)
          where i + k - 1 <= len(w) group by all having count(*) >= 30),
        n as (select lang, cast(sum(len(w)) as bigint) as n from p group by lang),
        cuts as (select lang, g, k, f as a, m, g[1:m] as lg, g[m + 1:] as rg from g, range(1, 4) t(m) where m < k),
        c as (select x.*, l.f as l, r.f as r, cast(cast(2000000 as hugeint) * a // (l.f + r.f) as bigint) as score
          from cuts x join g l on l.lang = x.lang and l.g = x.lg join g r on r.lang = x.lang and r.g = x.rg
          qualify row_number() over (partition by x.lang, x.g order by score, m) = 1),
        inner_parts as (select lang, g[i:i + len - 1] as g, max(a) as f from c, range(2, 4) s(len), range(1, 4) u(i)
          where len < k and i + len - 1 <= k group by 1, 2),
        covered as (select c.lang, c.g from c join inner_parts x on x.lang = c.lang and x.g = c.g
          where 100 * x.f >= 80 * c.a),
        ranked as (select lang,
            row_number() over (partition by lang order by score desc, a desc, array_to_string(g, ' ')) as rank,
            array_to_string(g, ' ') as phrase, a, l, r, score from c anti join covered using (lang, g))
        select lang, rank, phrase, a, l, r, n, score from ranked join n using (lang) where rank <= 2000""",
    "op11_merkle_manifest": f"""
        with recursive leaves as (select coalesce('=' || lang, '') as g, doc_id, {leaf_sql("text")} as h,
            case when {CRC} % 3 = 0 then {leaf_sql(LOWERED)} end as t,
            row_number() over (partition by lang order by doc_id) - 1 as pos, count(*) over (partition by lang) as n
          from documents),
        {climb_sql("nodes", "leaves")},
        subroots as (select '' as g, g as name, h, row_number() over (order by g) - 1 as pos, count(*) over () as n
          from nodes where n = 1),
        {climb_sql("upper", "subroots")},
        root as (select h as root from upper where n = 1),
        sides as ({siblings_sql("nodes")}),
        upper_sides as ({siblings_sql("upper")}),
        paths as (select doc_id, lvl, s.l, s.r from leaves x join sides s on s.g = x.g and s.pos = x.pos >> (3 * s.lvl)
          union all select doc_id, 1000 + lvl, s.l, s.r from leaves x join subroots t on t.name = x.g
          join upper_sides s on s.pos = t.pos >> (3 * s.lvl)),
        steps as (select *, row_number() over (partition by doc_id order by lvl) - 1 as step from paths),
        fold as (select doc_id, 0 as step, coalesce(t, h) as h from leaves
          union all select f.doc_id, f.step + 1, sha256(s.l || f.h || s.r)
          from fold f join steps s on s.doc_id = f.doc_id and s.step = f.step),
        proofs as (select doc_id, string_agg(l || r, '' order by step) as p from steps group by doc_id)
        select x.doc_id, x.h as leaf, t.h as subroot, root, sha256(coalesce(p, '')) as proof_sha256,
          f.h as folded_root, f.h = root as verified
        from leaves x join subroots t on t.name = x.g cross join root left join proofs using (doc_id)
        join (select doc_id, arg_max(h, step) as h from fold group by doc_id) f using (doc_id)""",
    "op6_line_dedup": f"""
        with l as (select doc_id, source, unnest(string_split(text, chr(10))) as line,
            generate_subscripts(string_split(text, chr(10)), 1) as pos from documents where text is not null),
        b as (select {BARE_LINE} as bare from l group by 1
            having count(distinct coalesce(source, chr(1))) >= 10 and {BARE_LINE} <> ''),
        k as (select doc_id, count(*) as n_lines, count(*) - count(b.bare) as left_lines,
            coalesce(string_agg(case when b.bare is null then line end, chr(10) order by pos), '') as text
            from l left join b on {BARE_LINE} = b.bare group by doc_id)
        select d.doc_id, coalesce(k.n_lines, 0) as n_lines, coalesce(k.n_lines - k.left_lines, 0) as n_removed,
          length(k.text) as kept_chars, sha256(k.text) as kept_sha256
        from documents d left join k on d.doc_id = k.doc_id""",
    "op3_decontamination": f"""
        with d as (select doc_id, unnest({SHINGLES}) as s from (select doc_id, {WORDS} as w from documents) x),
        i as (select item_id, {SHINGLES} as a from (select item_id, {WORDS} as w from benchmark) x),
        j as (select item_id, len(a) as n, unnest(a) as s from i)
        select doc_id, item_id, count(*) as shared, any_value(n) as item_shingles,
          cast(count(*) as double) / any_value(n) as containment
        from d join j using (s) group by doc_id, item_id having count(*) >= 0.8 * any_value(n)""",
}
