"""The registered queries of this package and, where SQL can state them, their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenurelake.llm import (
    chat, language, merkle, mixing, packing, pieces, quality_model, quality_rules, simhash, topk, toxicity, trie, url_rules,
)
from tenurelake.llm.common import remainder_is, table
from tenurelake.llm.ordering import crc_remainder
from tenurelake.session import checkpointed

# The rules of the URL query as (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
# The method's own verdict where none of these fits: URLs with one of these words are blocked.
URL_WORDS = ["casino", "porn", "viagra", "torrent", "warez"]


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.select("doc_id", simhash.hex_text("fp").alias("fingerprint"), "component_id")


def op2_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder_is("doc_id", 4, 2)
    model = language.train(docs.filter(~held_out))
    read = docs.select("doc_id", held_out.alias("held_out"), language.identify(docs, model).alias("p"))
    return read.select("doc_id", "held_out", "p.lang_pred", "p.score")


def op3_chat_format(spark, sf_dir: str) -> DataFrame:
    extra = spark.sql(
        "select * from values (-1L, 0L, 'user', '</s>[INST] ok [/INST]'),"
        " (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') as t(conv_id, turn, role, text)"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    done = chat.format_chats(rows)
    read = done.select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    line = lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        digest(F.array_join(F.transform("turns", line), "")).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), digest(F.col("loss")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_packing(spark, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    placed, at = mixing.place(docs)
    return placed.select("doc_id", "source", f"{at}.*")


def op6_top_k(spark, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def _scored(docs: DataFrame, score, holdout: tuple[int, int], threshold: float) -> DataFrame:
    scored = docs.select("doc_id", remainder_is("doc_id", *holdout).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op8_quality_model(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model.train(docs, table(spark, sf_dir, "labels"))
    return _scored(docs, quality_model.quality_score(docs, model), quality_model.HOLDOUT, 0.5)


def op9_url_rules(spark, sf_dir: str) -> DataFrame:
    rules = [url_rules.path_rule(*r) for r in URL_RULES] + [url_rules.word_rule(w) for w in URL_WORDS]
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_rules.judge_urls(pages, url_rules.rule_table(spark, rules))
    named = F.when(~F.startswith("rule", F.lit("word:")), F.col("rule"))
    return judged.select("page_id", "host", "path", named.alias("rule"), "verdict")


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return _scored(docs, toxicity.toxicity_score(docs, model), toxicity.HOLDOUT, model.threshold)


def op11_sentencepiece(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = docs.select("doc_id", pieces.encode("text").alias("ids"))
    back = coded.select("doc_id", "ids", pieces.decode("ids").alias("decoded"))
    return back.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


SHARED, HEADS = 20, 4  # a conversation begins with the first crc32 % HEADS turns of the first of SHARED


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of the first of their ``SHARED``, and the ids without a turn."""
    size = turns.groupBy("conv_id").agg(F.first("n").alias("n"))
    lead = size.select((F.col("conv_id")).alias("lead"), F.col("n").alias("lead_n"))
    convs = size.withColumns({"lead": F.col("conv_id") - F.col("conv_id") % SHARED, "heads": crc_remainder("conv_id", HEADS)})
    taken = F.least("heads", F.coalesce("lead_n", F.lit(0)))
    convs = checkpointed(convs.join(lead, "lead", "left").select("conv_id", "lead", "heads", "n", taken.alias("taken")))
    own = turns.drop("n").join(convs.select("conv_id", "heads", "taken"), "conv_id").filter("pos >= heads")
    starts = turns.filter(F.col("pos") < HEADS - 1).withColumnRenamed("conv_id", "lead").drop("n")
    borrowed = convs.filter("taken > 0").drop("n").join(starts, "lead").filter("pos < taken")
    columns = ["conv_id", "pos", "turn_id", "words"]
    moved = own.withColumn("pos", F.col("pos") - F.col("heads") + F.col("taken")).select(*columns)
    return moved.unionByName(borrowed.select(*columns)), convs.filter("taken = 0 and n <= heads").select("conv_id")


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    nodes, ends = trie.prefix_trie(*rebuilt(trie.ordered_turns(table(spark, sf_dir, "conversations"))))
    figures = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    return nodes.join(trie.ends_digest(ends), trie.NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", *[F.col(c).cast("long").alias(c) for c in figures],
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def op13_merkle(spark, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = table(spark, sf_dir, "documents").select(*columns)
    longer = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    hit = F.coalesce(crc_remainder("doc_id", 7) == 0, F.lit(False)) & F.col("n_chars").isNotNull()
    tampered = merkle.leaf(*[longer if c == "n_chars" else F.col(c) for c in columns])
    proved = merkle.manifest(docs, columns, "lang", "doc_id", {"tampered": F.when(hit, F.unhex(tampered))})
    leaf = F.coalesce(F.lower(F.hex("tampered")), "leaf")
    shown = proved.select(
        "doc_id", "leaf", "subroot", "root", merkle.digest(F.array_join(merkle.siblings(F.col("path")), "")).alias("proof_sha256"),
        merkle.fold(leaf, F.col("path")).alias("folded_root"),
    )
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


_TOP_SQL = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
  from embeddings where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
), scored as (
  select q.vec_id as query_id, c.vec_id,
    cast(list_sum(list_transform(generate_series(1, len(q.v)), lambda i: q.v[i] * c.v[i])) as bigint) as score
  from whole q join whole c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 100 = 0
)
select query_id, cast(rank as int) as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
) where rank <= 10
"""

_ESC = lambda c: (
    f"regexp_replace(regexp_replace(replace({c}, '&', '&amp;'), '<(\\||/?s>)', '&lt;\\1', 'g'),"
    " '\\[(/?INST\\])', '&#91;\\1', 'g')"
)

_CHAT_SQL = f"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), seen as (
  select *, lag(role) over (partition by conv_id order by turn nulls first, role, text) as before from rows
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length({_ESC('text')}) + case when before = role then {len(chat.NEXT)}
    else length({_ESC('role')}) + {len(chat.TURN + chat.TEXT + chat.END)} end) as bigint) as formatted_chars
from seen group by conv_id
"""

_URL_SQL = f"""
with parted as (
  select row_number() over () as k, page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), '{url_rules.UPPER}', '{url_rules.LOWER}') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from (select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages)
), rules(h, p, verdict) as (values {', '.join(map(str, URL_RULES))}),
best as (
  select k, arg_max(h || p, length(h || p)) as rule, arg_max(verdict, length(h || p)) as verdict
  from parted join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by k
)
select page_id, host, path, rule, coalesce(verdict, case when regexp_matches(host || path,
  '(?i)(^|[^\\pL\\pN])({'|'.join(URL_WORDS)})($|[^\\pL\\pN])') then 'block' else 'allow' end) as verdict
from parted left join best using (k)
"""

# crc32 of a text without a function for it: eight shifts a byte, the polynomial being a fixed value.
_CRC = lambda t: (
    f"xor(list_reduce(list_transform(range(1, length({t}) + 1), lambda i: ord(substr({t}, i, 1))::bigint), lambda c, b:"
    " list_reduce(range(8), lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, xor(c, b)),"
    " 4294967295::bigint), 4294967295)"
)

_TRIE_SQL = f"""
with told as (
  select conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as id,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as words
  from conversations where conv_id is not null
), seq as (
  select conv_id, cast({_CRC("cast(conv_id as varchar)")} % {HEADS} as int) as h,
    list(struct_pack(id := id, words := words) order by turn nulls first, id) as turns from told group by conv_id
), rebuilt as (
  select c.conv_id, coalesce(list_slice(b.turns, 1, c.h), []) || coalesce(list_slice(c.turns, c.h + 1, len(c.turns)), []) as path
  from seq c left join seq b on b.conv_id = c.conv_id - c.conv_id % {SHARED}
), members as (
  select conv_id, len(path) as n, unnest(range(0, len(path) + 1)) as depth, path from rebuilt
), nodes as (
  select depth, list_slice(path, 1, depth) as p, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (n = depth), '')) as ends_sha256
  from members group by all
), counted as (
  select n.*, u.conv_id as parent_conv_id, coalesce(c.n_children, 0) as n_children,
    case when n.depth > 0 then (n.n_convs - 1) * n.p[n.depth].words else 0 end as saved
  from nodes n left join nodes u on u.depth = n.depth - 1 and u.p = list_slice(n.p, 1, n.depth - 1)
  left join (select list_slice(p, 1, depth - 1) as p, count(*) as n_children from nodes where depth > 0 group by 1) c on c.p = n.p
), below as (
  select list_slice(p, 1, upto) as p, sum(case when n_children = 0 then 1 else 0 end) as n_leaves, sum(saved) as saved_tokens
  from (select *, unnest(range(0, depth + 1)) as upto from counted) group by 1
)
select conv_id, depth, parent_conv_id, n_convs, n_children, cast(n_leaves as bigint) as n_leaves,
  cast(saved_tokens as bigint) as saved_tokens, ends_sha256 from counted join below using (p)
"""

_FIELD = lambda c: f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"
_LEAF = lambda n: "sha256(" + " || ".join(map(_FIELD, ["doc_id", "source", "lang", n, "text"])) + ")"

_MERKLE_SQL = f"""
with recursive made as (
  select doc_id, dense_rank() over (order by lang nulls first) - 1 as tree, {_LEAF("n_chars")} as leaf,
    case when {_CRC("cast(doc_id as varchar)")} % 7 = 0 then {_LEAF("(n_chars::hugeint + 1)")} else {_LEAF("n_chars")} end as shown
  from documents
), placed as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos,
    count(*) over (partition by tree) as n, row_number() over () as k from made
), lower_nodes as (
  select tree, 0 as level, pos, leaf as h, n from placed
  union all
  select tree, level + 1, pos // 2, sha256(string_agg(h, '' order by pos)), (n + 1) // 2
  from lower_nodes where n > 1 group by tree, level, pos // 2, n
), upper_nodes as (
  select -1 as tree, 0 as level, tree as pos, h, count(*) over () as n from lower_nodes where n = 1
  union all
  select tree, level + 1, pos // 2, sha256(string_agg(h, '' order by pos)), (n + 1) // 2
  from upper_nodes where n > 1 group by tree, level, pos // 2, n
), nodes as (from lower_nodes union all from upper_nodes),
folds as (
  select k, tree, 0 as level, pos, n, shown as h, '' as proof from placed
  union all
  select k, case when f.n > 1 then f.tree else -1 end, case when f.n > 1 then f.level + 1 else 0 end,
    case when f.n > 1 then f.pos // 2 else f.tree end, case when f.n > 1 then (f.n + 1) // 2 else t.parts end,
    case when f.n = 1 then f.h when f.pos % 2 = 1 then sha256(s.h || f.h) else sha256(f.h || coalesce(s.h, '')) end,
    f.proof || coalesce(s.h, '')
  from folds f join (select count(distinct tree) as parts from placed) t on true
  left join nodes s on f.n > 1 and s.tree = f.tree and s.level = f.level and s.pos = xor(f.pos, 1)
  where f.n > 1 or f.tree >= 0
)
select doc_id, leaf, sub.h as subroot, top.h as root, sha256(proof) as proof_sha256, folds.h as folded_root,
  folds.h = top.h as verified
from placed join folds on folds.k = placed.k and folds.tree = -1 and folds.n = 1
join nodes sub on sub.tree = placed.tree and sub.n = 1 join nodes top on top.tree = -1 and top.n = 1
"""

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_language": op2_language,
    "op3_chat_format": op3_chat_format,
    "op4_packing": op4_packing,
    "op5_mixing": op5_mixing,
    "op6_top_k": op6_top_k,
    "op7_quality_rules": op7_quality_rules,
    "op8_quality_model": op8_quality_model,
    "op9_url_rules": op9_url_rules,
    "op10_toxicity": op10_toxicity,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_merkle": op13_merkle,
}
ORACLES = {
    "op3_chat_format": _CHAT_SQL,
    "op6_top_k": _TOP_SQL,
    "op9_url_rules": _URL_SQL,
    "op12_prefix_trie": _TRIE_SQL,
    "op13_merkle": _MERKLE_SQL,
}
