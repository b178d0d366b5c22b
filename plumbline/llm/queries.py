"""The registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import (
    brown,
    chat,
    hamming_search,
    merkle,
    mixing,
    packing,
    simhash,
    spelling,
    substring_dedup,
    toxicity,
    url_rules,
    warc,
    winnowing,
)
from plumbline.llm.common import remainder, stored, table
from plumbline.session import new_table_path


def word_vocabulary() -> str:
    """The installed vocabulary file that the packing contract names."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    return toxicity.train(docs, labels, remainder(F.col("doc_id"), 3) != 1)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(spark, docs, sf_dir)
    scored = toxicity.score_documents(docs, model).select("doc_id", "toxicity.*")
    return scored.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= model.settings.threshold).cast("int").alias("predicted"),
                         "sentences", "offending_start", "offending_end")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_table_path(spark, "archives")
    warc.write(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    return warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", "taken")


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow")]  # fixed values of the contract

URL_SQL = """
with parsed as (
    select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
    from pages),
pages2 as (
    select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
    from parsed),
rules(rule_host, rule_path, rule_verdict) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                             ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow'))
select page_id, host, path,
       (select rule_host || rule_path from rules
        where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
        order by length(rule_host || rule_path) desc limit 1) as rule,
       coalesce((select rule_verdict from rules
                 where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
                 order by length(rule_host || rule_path) desc limit 1), 'allow') as verdict
from pages2
"""


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 7) == 2
    blocks = brown.tokenise(table(spark, sf_dir, "documents").select("doc_id", "text", (~held_out).alias("train")))
    model, rarer = brown.cluster(blocks)
    coded = brown.encode(blocks, model, rarer)
    return brown.score_coded(coded, brown.with_transitions(model, coded.where("train"))).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


TOP_SQL = """
with codes as (
    select vec_id, list_sum(list_transform(embedding, lambda x, i: case when x > 0 then 1::hugeint << (i - 1)::int
                                                                 else 0::hugeint end))::hugeint as code
    from embeddings),
pairs as (
    select q.vec_id as query_id, c.vec_id, bit_count(xor(q.code, c.code))::int as distance
    from codes q, codes c where q.vec_id % 100 = 0)
select query_id, (row_number() over (partition by query_id order by distance, vec_id))::int as rank, vec_id, distance
from pairs
qualify rank <= 10
"""


def op7_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = hamming_search.top_k(vectors, vectors.where("id % 100 = 0"), 10)
    return found.withColumnRenamed("id", "vec_id")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), word_vocabulary()).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compare_edited(table(spark, sf_dir, "documents"))


EXTRA_TURN = "</s>[INST] ok [/INST]"  # fixed value of the contract

CHAT_SQL = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
escaped as (
    select *, length(replace(replace(replace(replace(replace(replace(role || ' ' || text, '\', '\\'),
        '<|', '<\|'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]')) - 1 as chars
    from turns)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(chars + length('<|im_start|><|im_sep|><|im_end|>'))::bigint as formatted_chars
from escaped group by conv_id
"""


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", EXTRA_TURN), (-7, 1, "assistant", EXTRA_TURN)], rows.schema)
    messages = rows.unionByName(extra).withColumn("parts", chat.text_part(F.col("text")))
    path = new_table_path(spark, "chat")
    chat.format_turns(messages).write.parquet(path)
    return chat.read_back(spark.read.parquet(path)).drop("attachment_tokens")


REPEATS_SQL = r"""
with texts as (
    select row_number() over () as rid, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
windows as (
    select rid, doc_id, i, array_to_string(words[i:i + 49], ' ') as seq
    from (select *, unnest(range(1, len(words) - 48)) as i from texts)),
earliest as (select seq, min(doc_id) as owner from windows group by seq),
hits as (select rid, i from windows join earliest using (seq) where doc_id > owner or (doc_id is null and owner is not null)),
gone as (select distinct rid, i + j as place from hits, range(50) r(j)),
kept as (
    select rid, string_agg(word, ' ' order by place) as kept, count(*) as n
    from (select rid, unnest(words) as word, generate_subscripts(words, 1) as place from texts) anti join gone using (rid, place)
    group by rid)
select doc_id, len(words)::bigint as n_words, (len(words) - coalesce(n, 0))::bigint as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from texts left join kept using (rid)
"""


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def crc_sql(value: str) -> str:
    """The unsigned crc32 of a text in SQL, byte by byte and bit by bit; the polynomial is a fixed value of the format."""
    byte = f"list_transform(range(strlen({value})), lambda i: ('0x' || substr(hex(encode({value})), 2 * i::int + 1, 2))::bigint)"
    return (f"xor(list_reduce(list_prepend(4294967295::bigint, {byte}), lambda c, b: list_reduce(list_prepend(xor(c, b), "
            "range(8)), lambda d, _: case when d & 1 = 1 then xor(d >> 1, 3988292384::bigint) else d >> 1 end)), "
            "4294967295::bigint)")


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(n_chars: str) -> str:
    return ("sha256(" + " || ".join(map(_field, ("doc_id::varchar", "source", "lang", f"({n_chars})::varchar", "text"))) + ")")


MERKLE_SQL = f"""
with recursive given as (
    select *, coalesce('=' || lang, '') as tree, {_leaf('n_chars')} as leaf,
           case when {crc_sql('doc_id::varchar')} % 7 = 0 then {_leaf('n_chars + 1')} else {_leaf('n_chars')} end as claimed
    from documents),
placed as (
    select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as idx,
           count(*) over (partition by tree) as n from given),
nodes as (
    select tree, 0 as level, idx, n, leaf as digest from placed
    union all
    select tree, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' order by idx))
    from nodes where n > 1 group by tree, level, idx // 2, n),
subroots as (
    select tree, digest, row_number() over (order by encode(tree)) - 1 as idx, count(*) over () as n
    from nodes where n = 1),
upper as (
    select 0 as level, idx, n, digest from subroots
    union all
    select level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' order by idx))
    from upper where n > 1 group by level, idx // 2, n),
-- A step per level: the sibling, and whether it stands on the right.
steps as (
    select p.tree, p.idx as leaf_idx, a.level, s.digest, s.idx > a.idx as on_right
    from placed p join nodes a on a.tree = p.tree and a.idx = p.idx >> a.level and a.n > 1
    left join nodes s on s.tree = a.tree and s.level = a.level and s.idx = xor(a.idx, 1)
    union all
    select p.tree, p.idx, 100 + a.level, s.digest, s.idx > a.idx
    from placed p join subroots t on t.tree = p.tree join upper a on a.idx = t.idx >> a.level and a.n > 1
    left join upper s on s.level = a.level and s.idx = xor(a.idx, 1)),
paths as (
    select tree, leaf_idx as idx, sha256(coalesce(string_agg(digest, '' order by level), '')) as proof,
           list({{'d': digest, 'r': on_right}} order by level) as path
    from steps group by all),
whole as (
    select p.doc_id, p.leaf, t.digest as subroot, (select digest from upper where n = 1) as root,
           coalesce(q.proof, sha256('')) as proof_sha256,
           list_reduce(list_prepend({{'d': p.claimed, 'r': true}}, coalesce(q.path, [])), lambda a, s:
               {{'d': case when s.d is null then sha256(a.d) when s.r then sha256(a.d || s.d) else sha256(s.d || a.d) end,
                  'r': true}}).d as folded_root
    from placed p join subroots t using (tree) left join paths q on q.tree = p.tree and q.idx = p.idx)
select doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root as verified from whole
"""


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = merkle.manifest(table(spark, sf_dir, "documents"), claim=(tampered, {"n_chars": F.col("n_chars") + 1}))
    return merkle.proofs(found).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                       (F.col("folded_root") == F.col("root")).alias("verified"))


SPELLING_SQL = rf"""
with recursive runs as (
    select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
    from (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) as run from documents)),
counted as (
    select doc_id, run, count(*) as c, coalesce(doc_id::varchar, '') || ':' || run as k
    from runs where length(run) >= 7 group by all),
hashed as (select run, c, {crc_sql('k')} as h from counted),
made as (
    select case when h % 31 = 0 then left(run, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2)
                else run end as word, c from hashed),
words as (select word, sum(c)::bigint as n from made where length(word) >= 7 group by word having sum(c) >= 2),
skips as (
    select word, n, left(word, i) as a, substr(word, i + 2) as b
    from (select *, unnest(range(length(word))) as i from words)),
pairs as (
    select s.word, t.word as other, t.n as other_n from skips s join skips t on s.a = t.a and s.b = t.b and s.word <> t.word
    union
    select s.word, u.word, u.n from skips s join words u on u.word = s.a || s.b
    union
    select u.word, s.word, s.n from skips s join words u on u.word = s.a || s.b),
best as (
    select word, count(*) as n_near, max(other_n) as top_n, arg_min(other, (-other_n, other)) as top from pairs group by word),
judged as (
    select word, n, coalesce(n_near, 0) as n_near, case when top_n >= 10 * n then top end as form,
           case when top_n >= 10 * n then top_n end as form_n from words left join best using (word)),
chains as (
    select word, word as at_word, 0 as steps from judged
    union all
    select c.word, j.form, steps + 1 from chains c join judged j on j.word = c.at_word where j.form is not null),
ends as (select word, arg_max(at_word, steps) as root from chains group by word)
select word, form, root, n, n_near, form_n from judged join ends using (word)
"""


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = spelling.words(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return spelling.variants(stored(counted, "words"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_warc": op2_warc,
    "op3_mixing": op3_mixing,
    "op4_url_rules": op4_url_rules,
    "op5_simhash": op5_simhash,
    "op6_brown": op6_brown,
    "op7_hamming_top_k": op7_hamming_top_k,
    "op8_packing": op8_packing,
    "op9_winnowing": op9_winnowing,
    "op10_chat": op10_chat,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_merkle": op12_merkle,
    "op13_spelling": op13_spelling,
    "pipeline": pipeline,
}

SQL: dict[str, str] = {"op4_url_rules": URL_SQL, "op7_hamming_top_k": TOP_SQL, "op10_chat": CHAT_SQL,
                       "op11_substring_dedup": REPEATS_SQL, "op12_merkle": MERKLE_SQL,
                       "op13_spelling": SPELLING_SQL}
