"""Registered queries of the operators in this package, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, embedding_dedup, hard_negatives, language_model, licenses, merkle, mixing, near_dedup, packing, personal_data, substring_dedup, top_k, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    held = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "text")
    out = toxicity.score(held, model, ["doc_id", "held_out"])
    return out.select("doc_id", "held_out", F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.remove_repeated_passages(_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"), licenses.builtin_templates(spark, short=True))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize(_table(spark, sf_dir, "documents"), _tokenizer())
    return packing.pack(pieces.drop("ids"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.held_out_scores(_table(spark, sf_dir, "documents"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), top_k.whole(F.col("embedding")).alias("vector"))
    return top_k.top_k(rows, rows.where("id % 100 = 0"), 10)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.report(_table(spark, sf_dir, "documents"))


# Every source belongs to a made-up domain; some nodes of each level of the tree weigh more than others.
DOMAIN = "concat('d', cast(coalesce(length(source), 0) % 3 as string))"
MIX_WEIGHTS = {("d1",): 3, ("d2",): 2, ("d1", "en"): 5, ("d2", "de"): 4, ("d1", "en", "src0"): 2, ("d2", "en", "src10"): 3}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.5, 2, 17


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = {"domain": F.expr(DOMAIN), "lang": F.col("lang"), "source": F.col("source")}
    mixed = mixing.select(_table(spark, sf_dir, "documents"), levels, MIX_SHARE, MIX_EPOCHS, MIX_WEIGHTS, MIX_SEED)
    return mixed.select("doc_id", "lang", "source", F.col("mix_epoch").alias("epoch"), F.col("mix_tokens").alias("n_tokens"))


CONFLICT = "</s>[INST] ok [/INST]"  # what both turns of conversation -7 say


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    extra = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(CONFLICT).alias("text"))
    return chat.read_back(chat.format_conversations(rows.unionByName(extra)), in_order=True)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), label.alias("label"), top_k.whole(F.col("embedding"), 256).alias("vector"))
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = merkle.digest(*fields, F.translate("text", _UPPER, _UPPER.lower()))
    altered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lowered)
    docs = _table(spark, sf_dir, "documents")
    manifest = merkle.build(docs, F.col("lang"), "doc_id", merkle.digest(*fields, F.col("text")), doc_id=F.col("doc_id"), altered=altered)
    proven = merkle.proofs(manifest).withColumn("folded_root", merkle.folded(F.coalesce("altered", "node"), F.col("path")))
    return proven.select(
        "doc_id", F.col("node").alias("leaf"), "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_near_dedup": op3_near_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_exact_top_k": op8_exact_top_k,
    "op9_pii": op9_pii,
    "op10_mixing": op10_mixing,
    "op11_chat_format": op11_chat_format,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_merkle_manifest": op13_merkle_manifest,
}



def _mix_sql() -> str:
    """The same budgets by window functions on exact integers, and prefixes by one running sum per leaf."""
    levels = ("domain", "lang", "source")
    parts = []
    for i, _ in enumerate(levels):
        node, parent = ", ".join(levels[: i + 1]), ", ".join(levels[:i])
        cases = [(path, w) for path, w in MIX_WEIGHTS.items() if len(path) == i + 1]
        weight = "1" if not cases else "case " + " ".join(f"when ({node}) = ({', '.join(map(repr, p))}) then {w}" for p, w in cases) + " else 1 end"
        by = f"partition by {parent}" if parent else ""
        up = f"join g{i} using ({parent})" if parent else "cross join goal"
        budget = "given" if parent else "goal.budget"
        parts.append(f"""
c{i + 1} as (select {node}, cast(cap as hugeint) as cap, cast({weight} as hugeint) as w, cast({budget} as hugeint) as budget
             from (select {node}, sum(tokens) * {MIX_EPOCHS} as cap from leaves group by {node}) {up}),
o{i + 1} as (select *, budget - coalesce(sum(cap) over (win rows between unbounded preceding and 1 preceding), 0) as rest,
             sum(w) over (win rows between current row and unbounded following) as weight
             from c{i + 1} window win as ({by} order by cap / w, {node})),
f{i + 1} as (select *, rest > 0 and cap * weight <= rest * w as filled from o{i + 1}),
p{i + 1} as (select *, first_value(case when not filled then rest end ignore nulls) over (win rows between unbounded preceding and unbounded following) as r,
             first_value(case when not filled then weight end ignore nulls) over (win rows between unbounded preceding and unbounded following) as ww
             from f{i + 1} window win as ({by} order by cap / w, {node})),
s{i + 1} as (select *, case when filled then cap else least(cap, greatest(r, 0) * w // ww) end as share from p{i + 1}),
g{i + 1} as (select {node}, share + case when not filled and share < cap and
             sum(case when not filled and share < cap then 1 else 0 end) over ({by} order by cap / w, {node} rows unbounded preceding)
             <= budget - sum(share) over ({by}) then 1 else 0 end as given from s{i + 1})""")
    return rf"""
with d as (select *, 'd' || (coalesce(length(source), 0) % 3) as domain, len(coalesce({_WORDS.format("text")}, [])) as n from documents),
leaves as (select domain, lang, source, sum(n) as tokens from d group by all),
goal as (select cast(floor({MIX_SHARE} * sum(n)) as bigint) as budget from d), {",".join(parts)},
cut as (select domain, lang, source, cast(given as bigint) as given, cast(case when tokens > 0 then given // tokens else {MIX_EPOCHS} end as bigint) as whole, tokens
        from g3 join leaves using (domain, lang, source)),
run as (select d.doc_id, d.lang, d.source, n, whole, given - whole * tokens as rest,
        sum(n) over (partition by domain, lang, source order by md5('{MIX_SEED}-' || whole || '-' || doc_id)) as upto
        from d join cut using (domain, lang, source)),
every as (select doc_id, lang, source, e as epoch, n from run join (select unnest(range(0, {MIX_EPOCHS})) as e) on e < whole
         union all select doc_id, lang, source, whole, n from run where whole < {MIX_EPOCHS} and upto <= rest)
select doc_id, lang, source, cast(epoch as int) as epoch, cast(n as bigint) as n_tokens from every
"""


def _merkle_sql(levels: int = 8, tops: int = 4) -> str:
    """The tree level by level, for up to 8^levels rows of a language and 8^tops languages."""
    of = lambda c: f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"
    row = lambda text: "sha256(" + " || ".join([*map(of, ("doc_id", "source", "lang", "n_chars")), of(text)]) + ")"
    parts = []
    for name, depth in (("a", levels), ("b", tops)):
        for j in range(depth):
            run = f"(partition by tree, pos // 8 order by pos rows between {{}})"
            before, after = run.format("unbounded preceding and 1 preceding"), run.format("1 following and unbounded following")
            parts.append(f"""
{name}s{j} as (select tree, pos, n, coalesce(string_agg(node, '') over {before}, '') as l, coalesce(string_agg(node, '') over {after}, '') as r from {name}{j}),
{name}{j + 1} as (select tree, pos // 8 as pos, any_value((n + 7) // 8) as n,
  case when any_value(n) > 1 then sha256(string_agg(node, '' order by pos)) else any_value(node) end as node from {name}{j} group by tree, pos // 8)""")
        if name == "a":
            parts.append(f"""
b0 as (select '' as tree, tree as of, row_number() over (order by tree) - 1 as pos, count(*) over () as n, node from a{levels})""")
    fold, proof, joins = "coalesce(altered, a0.node)", [], []
    for name, depth in (("a", levels), ("b", tops)):
        for j in range(depth):
            x = f"{name}s{j}"
            fold = f"case when {x}.n > 1 then sha256({x}.l || {fold} || {x}.r) else {fold} end" if j == 0 and name == "a" else fold
            proof.append(f"case when {x}.n > 1 then {x}.l || {x}.r else '' end")
            joins.append(f"join {x} on {x}.tree = {name}0.tree and {x}.pos = {name}0.pos // {8**j}")
        if name == "a":
            joins.append("join b0 on b0.of = a0.tree")
    folds, held = [], "folded"
    for name, depth in (("a", levels), ("b", tops)):
        for j in range(depth):
            if (name, j) != ("a", 0):
                folds.append(f"case when {name}n{j} > 1 then sha256({name}l{j} || folded || {name}r{j}) else folded end as folded")
    carried = ", ".join(f"{n}s{j}.{c} as {n}{c}{j}" for n, d in (("a", levels), ("b", tops)) for j in range(d) for c in "nlr" if (n, j) != ("a", 0))
    steps = [f"f0 as (select doc_id, a0.node as leaf, a{levels}.node as subroot, b{tops}.node as root, sha256({' || '.join(proof)}) as proof_sha256, {fold} as {held}, {carried}"
             f" from a0 {' '.join(joins)} join a{levels} on a{levels}.tree = a0.tree join b{tops} on true)"]
    steps += [f"f{i + 1} as (select * replace ({f}) from f{i})" for i, f in enumerate(folds)]
    return f"""
with crc as (select doc_id, xor(4294967295, list_reduce([cast(ord(c) as bigint) for c in string_split(cast(doc_id as varchar), '')],
  lambda a, b: list_reduce(range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(a, b)), cast(4294967295 as bigint))) as crc
  from (select distinct doc_id from documents where doc_id is not null)),
a0 as (select coalesce('1' || lang, '0') as tree, row_number() over (partition by lang order by doc_id) - 1 as pos, count(*) over (partition by lang) as n,
  {row("text")} as node, case when crc % 3 = 0 then {row(_LOWER.format("text"))} end as altered, doc_id
  from documents left join crc using (doc_id)), {",".join(parts)},
{", ".join(steps)}
select doc_id, leaf, subroot, root, proof_sha256, folded as folded_root, folded = root as verified from f{len(folds)}
"""


_CONTROL = r"\[\\*(/?(INST|SYS|ROLE)|OUT)\]|<\\*/?s>"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op2_substring_dedup": rf"""
with d as (select doc_id, coalesce({_WORDS.format("text")}, []) as w from documents),
win as (select doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') as g
        from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from d)),
own as (select g, min(doc_id) as owner from win group by g),
hit as (select win.doc_id, win.i from win join own using (g) where own.owner < win.doc_id),
gone as (select distinct doc_id, i + k as p from hit, (select unnest(range(0, 13)) as k)),
word as (select doc_id, w[p] as x, p from (select doc_id, w, unnest(range(1, len(w) + 1)) as p from d)),
kept as (select word.doc_id, string_agg(x, ' ' order by word.p) as t from word anti join gone on word.doc_id = gone.doc_id and word.p = gone.p
         group by word.doc_id),
cut as (select doc_id, count(*) as n from gone group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join cut using (doc_id) left join kept using (doc_id)
""",
    "op3_near_dedup": rf"""
with recursive d as (select doc_id, coalesce({_WORDS.format(_LOWER.format("text"))}, []) as w from documents),
s as (select distinct doc_id, array_to_string(list_slice(w, i, i + 3), ' ') as g
      from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
pair as (select a.doc_id as a, b.doc_id as b, count(*) as m from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by all),
link as (select a, b from pair join n x on x.doc_id = a join n y on y.doc_id = b where 100 * m >= 80 * (x.n + y.n - m)),
walk as (select a as doc_id, b as seen from link union select walk.doc_id, link.b from walk join link on walk.seen = link.a),
low as (select doc_id, min(seen) as c from walk group by doc_id)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, least(d.doc_id, coalesce(c, d.doc_id)) as component_id,
       least(d.doc_id, coalesce(c, d.doc_id)) = d.doc_id as kept
from d left join n using (doc_id) left join low using (doc_id)
""",
    "op4_license_scan": rf"""
with t as (select * from (values {", ".join(f"('{k}', '{v}')" for k, v in (licenses.TEMPLATES | licenses.SHORT_TEMPLATES).items())}) v(template_id, text)),
tw as (select template_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') as w from t),
ts as (select distinct template_id, array_to_string(list_slice(w, i, i + 4), ' ') as g from (select *, unnest(range(1, len(w) - 3)) as i from tw)),
tn as (select template_id, greatest(len(w) // 4, 1) as every, len(w) - 5 + greatest(len(w) // 4, 1) as width,
       (select count(*) from ts where ts.template_id = tw.template_id) as size from tw),
d as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') as w from documents),
s as (select doc_id, i - 1 as pos, array_to_string(list_slice(w, i, i + 4), ' ') as g from (select *, unnest(range(1, len(w) - 3)) as i from d)),
hit as (select doc_id, template_id, pos, g, every, width, size from s join ts using (g) join tn using (template_id)),
win as (select *, unnest(range(greatest(0, cast(ceil((pos - width + 1) / every) as bigint)), pos // every + 1)) * every as start from hit),
met as (select doc_id, template_id, start, size, count(distinct g) as n from win where start + width > pos group by all having 100 * count(distinct g) >= 80 * size),
line as (select doc_id, i - 1 as pos, list_slice(w, i, i + n - 1) as g, n from (select *, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct len(w) as n from tw where len(w) < 5))),
few as (select doc_id, template_id, pos as start, 1 as size, 1 as n from line join tw on line.n = len(tw.w) and line.g = tw.w)
select doc_id, template_id, max(n / size) as containment, cast(min(start) as bigint) as first_word, count(*) as n_windows from (from met union all from few) group by all
""",
    "op8_exact_top_k": """
with e as (select vec_id, [cast(floor(1024 * cast(x as double)) as bigint) for x in embedding] as v from embeddings
           where embedding is not null and vec_id is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (select q.vec_id as query_id, c.vec_id, cast(list_sum([a[1] * a[2] for a in list_zip(q.v, c.v)]) as bigint) as score
      from e q join e c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)),
r as (select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score from s)
select * from r where rank <= 10
""",
    "op10_mixing": _mix_sql(),
    "op11_chat_format": rf"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '{CONFLICT}' union all select -7, 1, 'assistant', '{CONFLICT}'),
m as (select *, length(text) + 2 + len(regexp_extract_all(text, '{_CONTROL}'))
  + case role when 'system' then 11 when 'user' then 13 when 'assistant' then 9 else 17 + length(role) + len(regexp_extract_all(role, '{_CONTROL}')) end as chars from c)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(3 + sum(chars) as bigint) as formatted_chars
from m group by conv_id
""",
    "op12_hard_negatives": """
with e as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as v
  from embeddings where embedding is not null and vec_id is not null and label is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (select a.vec_id as anchor_id, a.label as own, c.vec_id, c.label, cast(list_sum([p[1] * p[2] for p in list_zip(a.v, c.v)]) as bigint) as score
  from e a join e c on a.vec_id % 100 = 0 and a.vec_id <> c.vec_id and len(a.v) = len(c.v)),
p as (select * from s where own = label qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.vec_id as positive_id, cast(row_number() over (partition by p.anchor_id, p.vec_id order by n.score desc, n.vec_id) as int) as rank,
  n.vec_id as negative_id, p.score as positive_score, n.score as negative_score
from p join s n on n.anchor_id = p.anchor_id and n.label <> n.own and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
qualify rank <= 10
""",
    "op13_merkle_manifest": _merkle_sql(),
}
