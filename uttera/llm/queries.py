"""The queries of the thirteen operators over their whole tables, with SQL where SQL can express them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uttera.llm import (
    byte_network,
    chat,
    cover_codes,
    decontaminate,
    language,
    licenses,
    merkle,
    mixing,
    pii,
    quality_rules,
    reputation,
    simhash,
    sketch,
)
from uttera.llm.common import held_out, learnable, table
from uttera.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The rules of the URL filter, by host and path.
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def query(function: Callable) -> Callable:
    QUERIES[function.__name__] = function
    return function


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items they hold, with the best window of each pair."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly"
    )


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), size=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("simhash")), 16, "0").alias("fingerprint"), "component_id")


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


@query
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op6_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes are the labels of the rows with the page's number: bad is low quality or toxic."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad")
    outcomes = pages.join(table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad), "page_id").select("url", "bad")
    judged = reputation.judge(pages, outcomes, RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("bad_mean", 6).alias("bad_mean"))


@query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.filter(learnable(F.col("doc_id"))))
    found = language.identify(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query
def op8_quality_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").filter(learnable(F.col("doc_id")))
    network = byte_network.fit(docs, labels)
    scored = byte_network.score(docs, network).withColumn("held_out", held_out(F.col("doc_id")))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    narrow = docs.select(
        "doc_id", "source", "lang", mixing.topic_of(F.col("text")).alias("topic"), mixing.token_count(F.col("text")).alias("n_tokens"),
        F.md5(F.coalesce("text", F.lit(""))).alias("mark"),
    )
    return mixing.mix(materialize(narrow, "tokens"), mark=F.col("mark")).select("doc_id", "source", "lang", "topic", "n_tokens", "probability", "sampled")


@query
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


@query
def op11_cover_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, codebooks = cover_codes.compress(table(spark, sf_dir, "embeddings"))
    return codes.withColumn("codebooks_sha256", F.lit(cover_codes.digest(codebooks)))


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"))


@query
def op13_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.edit_check(table(spark, sf_dir, "documents"))


def _licenses_sql() -> str:
    pairs = []
    for phrase, source in (("true", licenses.PHRASES), ("false", licenses.TEMPLATES)):
        for sentence, label in source.items():
            split = sentence.split()
            pairs += [f"('{a}','{b}','{sentence}/{phrase}',{i},{len(split) - 1},{phrase},'{label}')" for i, (a, b) in enumerate(zip(split, split[1:], strict=False))]
    return rf"""
WITH templates(a, b, template, place, pairs, phrase, label) AS (VALUES {', '.join(pairs)}),
read AS (SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
placed AS (SELECT rn, unnest(w) AS a, generate_subscripts(w, 1) - 1 AS pos FROM read),
pairs AS (SELECT p.rn, p.pos, p.a, q.a AS b FROM placed p JOIN placed q ON p.rn = q.rn AND q.pos = p.pos + 1),
hits AS (SELECT rn, template, pairs, phrase, label, pos - place AS diagonal, place FROM pairs JOIN templates USING (a, b)),
apart AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER w > {licenses.GAP} THEN 1 ELSE 0 END AS apart
    FROM hits WINDOW w AS (PARTITION BY rn, template ORDER BY diagonal, place)),
regions AS (SELECT *, CASE WHEN phrase THEN diagonal
    ELSE sum(apart) OVER (PARTITION BY rn, template ORDER BY diagonal, place ROWS UNBOUNDED PRECEDING) END AS region FROM apart),
spans AS (SELECT rn, template, label, phrase, pairs, region, count(DISTINCT place) AS held, min(diagonal) AS start
    FROM regions GROUP BY ALL),
found AS (SELECT rn, phrase AND held = pairs AS stands, NOT phrase AND held / pairs >= {licenses.COVERAGE} AS near,
    start, label, held / pairs AS cover FROM spans)
SELECT r.doc_id, len(r.w)::BIGINT AS n_words, count(*) FILTER (stands)::BIGINT AS n_base,
    min(start) FILTER (stands)::BIGINT AS first_word, max(start) FILTER (stands)::BIGINT AS last_word,
    coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (stands)), ','), '') AS base_labels,
    coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (stands OR near)), ','), '') AS labels,
    coalesce(round(max(cover), 6), 0)::DOUBLE AS score
FROM read r LEFT JOIN found f ON r.rn = f.rn GROUP BY r.rn, r.doc_id, r.w
"""


def _reputation_sql() -> str:
    second = "|".join(reputation.SECOND_LEVELS)

    def worth(groups: str) -> str:
        chance = "n * prior * (1 - prior)"
        found = f"sum((bad - n * prior) ** 2 - {chance}) / nullif(sum({chance} * (n - 1)), 0)"
        return f"""(SELECT CASE WHEN r > 0 THEN least({reputation.MOST}, greatest({reputation.LEAST}, 1 / r - 1)) ELSE {reputation.MOST} END
    FROM (SELECT {found} AS r FROM {groups}))"""

    ordered = sorted(RULES, key=lambda r: (-len(r[1]), r[1]))

    def choose(value: int) -> str:
        arms = []
        for rule in ordered:
            name, slash, rest = rule[1].partition("/")
            arms.append(f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash + rest}') THEN '{rule[value]}'")
        return f"CASE {' '.join(arms)} END"

    return f"""
WITH placed AS (SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
named AS (SELECT *, regexp_replace(host, ':[0-9]*$', '') AS name FROM placed),
levels AS (SELECT *, CASE WHEN regexp_full_match(name, '[0-9]+([.][0-9]+){{3}}') THEN name
        WHEN regexp_matches(name, '[.]({second})[.][a-z][a-z]$') THEN regexp_extract(name, '([^.]*[.])?[^.]*[.][^.]*$', 0)
        ELSE regexp_extract(name, '([^.]*[.])?[^.]*$', 0) END AS domain,
    CASE WHEN regexp_full_match(name, '[0-9]+([.][0-9]+){{3}}') THEN '{reputation.ADDRESS}'
        WHEN regexp_matches(name, '[.]({second})[.][a-z][a-z]$') THEN regexp_extract(name, '[^.]*[.][^.]*$', 0)
        ELSE regexp_extract(name, '[^.]*$', 0) END AS suffix FROM named),
hosts AS MATERIALIZED (SELECT suffix, domain, host, coalesce(sum(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END)
        FILTER (doc_id IS NOT NULL), 0)::DOUBLE AS bad, count(doc_id)::DOUBLE AS n
    FROM levels LEFT JOIN labels ON page_id = doc_id GROUP BY ALL),
s1 AS MATERIALIZED (SELECT suffix, sum(bad) AS bad, sum(n) AS n, coalesce((SELECT sum(bad) / nullif(sum(n), 0) FROM hosts), 0) AS prior FROM hosts GROUP BY suffix),
s2 AS MATERIALIZED (SELECT suffix, (bad + w * prior) / (n + w) AS prior FROM s1, (SELECT {worth('s1')} AS w)),
d1 AS MATERIALIZED (SELECT h.suffix, domain, sum(bad) AS bad, sum(n) AS n, any_value(prior) AS prior FROM hosts h JOIN s2 USING (suffix) GROUP BY ALL),
d2 AS MATERIALIZED (SELECT suffix, domain, (bad + w * prior) / (n + w) AS prior FROM d1, (SELECT {worth('d1')} AS w)),
h1 AS MATERIALIZED (SELECT host, bad, n, prior FROM hosts h JOIN d2 USING (suffix, domain)),
rated AS (SELECT host, (bad + w * prior) / (n + w) AS mean, n, w FROM h1, (SELECT {worth('h1')} AS w))
SELECT page_id, l.host, path, {choose(1)} AS rule,
    coalesce({choose(0)}, CASE WHEN mean - {reputation.Z} * sqrt(mean * (1 - mean) / (n + w + 1)) > {reputation.BLOCK_ABOVE}
        THEN 'block' ELSE 'allow' END) AS verdict, round(mean, 6) AS bad_mean
FROM levels l JOIN rated r ON l.host = r.host
""".replace(" host = '", " l.host = '").replace("(host = '", "(l.host = '").replace("ends_with(host,", "ends_with(l.host,")


#: Rounds in which the SQL raises the level of an axis' targets; more than its values ever need.
SQL_ROUNDS = 12


def _mixing_sql() -> str:
    b = mixing.BUDGET
    steps = []
    for axis, power in mixing.TEMPERATURES.items():
        steps.append(f"h_{axis} AS MATERIALIZED (SELECT {axis}, sum(tokens)::DOUBLE AS held, pow(sum(tokens)::DOUBLE, {power}) AS share FROM cells GROUP BY {axis})")
        steps.append(f"l_{axis}_0 AS MATERIALIZED (SELECT {b} * sum(held) / sum(share) AS level FROM h_{axis})")
        for k in range(SQL_ROUNDS):
            steps.append(f"""l_{axis}_{k + 1} AS MATERIALIZED (SELECT coalesce(greatest(level, ({b} * (SELECT sum(held) FROM h_{axis})
    - coalesce(sum(held) FILTER (share * level > held), 0)) / sum(share) FILTER (share * level <= held)), level) AS level
    FROM h_{axis}, l_{axis}_{k} GROUP BY level)""")
        steps.append(f"g_{axis} AS MATERIALIZED (SELECT {axis}, least(share * level, held) AS goal FROM h_{axis}, l_{axis}_{SQL_ROUNDS})")
    goals = " ".join(f"JOIN g_{a} ON c.{a} IS NOT DISTINCT FROM g_{a}.{a}" for a in mixing.AXES)
    steps.append(f"w0 AS MATERIALIZED (SELECT c.*, {b} * tokens AS raw, {', '.join(f'g_{a}.goal AS goal_{a}' for a in mixing.AXES)} FROM cells c {goals})")
    at = "w0"
    for i in range(mixing.SWEEPS):
        for axis in mixing.AXES:
            to = f"w{i}_{axis}"
            steps.append(f"""{to} AS MATERIALIZED (SELECT * EXCLUDE (held) REPLACE (CASE WHEN held > 0 THEN raw * goal_{axis} / held ELSE 0 END AS raw)
    FROM (SELECT *, sum(least(raw, tokens)) OVER (PARTITION BY {axis}) AS held FROM {at}))""")
            at = to
    same = " AND ".join(f"t.{a} IS NOT DISTINCT FROM w.{a}" for a in mixing.AXES)
    return rf"""
WITH t AS (SELECT doc_id, source, lang, md5(coalesce(text, '')) AS mark, CASE WHEN contains(text, ' | ') THEN 'table'
    WHEN contains(text, 'License') OR contains(text, 'rights reserved') THEN 'licensed'
    WHEN contains(text, '@') OR contains(text, '<EMAIL>') OR contains(text, '<OBFUSCATED_EMAIL>') THEN 'contact' ELSE 'prose' END AS topic,
    len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+'))::BIGINT AS n_tokens FROM documents),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::BIGINT AS tokens FROM t GROUP BY ALL), {', '.join(steps)}
SELECT doc_id, t.source, t.lang, t.topic, n_tokens, probability, ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, 'null')
    || ':' || mark || ':0'), 1, 8))::BIGINT / 4294967296.0 < probability AS sampled
FROM t JOIN (SELECT *, CASE WHEN tokens > 0 THEN round(least(raw, tokens) / tokens, 6) ELSE 0 END AS probability FROM {at}) w ON {same}
"""


def _cover_codes_sql() -> str:
    """Every vector against every entry, one common table expression a round."""
    rounds, books = [], "b0"
    for i in range(cover_codes.ROUNDS + 1):
        # Integers below 2^53 are exact in the doubles of the inner product.
        rounds.append(f"""a{i} AS MATERIALIZED (SELECT rn, p.part, min({{'d': p.norm - 2 * list_inner_product(p.x, b.x) + b.norm, 'e': entry}}) AS near
    FROM pieces p JOIN {books} b ON p.part = b.part GROUP BY ALL)""")
        if i < cover_codes.ROUNDS:
            rounds.append(f"""m{i} AS MATERIALIZED (SELECT part, entry, list(mean ORDER BY place) AS x FROM (
    SELECT part, near.e AS entry, place, floor(sum(v) / count(*)) AS mean FROM (
        SELECT a.part, near, unnest(x) AS v, generate_subscripts(x, 1) AS place FROM a{i} a JOIN pieces p ON a.rn = p.rn AND a.part = p.part)
    GROUP BY ALL) GROUP BY ALL)""")
            rounds.append(f"""b{i + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x, list_inner_product(coalesce(m.x, b.x), coalesce(m.x, b.x)) AS norm
    FROM {books} b LEFT JOIN m{i} m ON b.part = m.part AND b.entry = m.entry)""")
            books = f"b{i + 1}"
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rn, vec_id, label,
    list_transform(embedding, lambda x: floor({cover_codes.SCALE} * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0),
pieces AS MATERIALIZED (SELECT *, list_inner_product(x, x) AS norm FROM (
    SELECT rn, part, v[part * len(v) // {cover_codes.PARTS} + 1 : (part + 1) * len(v) // {cover_codes.PARTS}] AS x
    FROM kept, range({cover_codes.PARTS}) r(part))),
seeds AS (SELECT rn, row_number() OVER (ORDER BY rn) - 1 AS entry
    FROM (SELECT min(rn) AS rn FROM kept GROUP BY vec_id) ORDER BY rn LIMIT {cover_codes.ENTRIES}),
b0 AS MATERIALIZED (SELECT part, entry, x, norm FROM pieces JOIN seeds USING (rn)), {', '.join(rounds)},
coded AS (SELECT rn, string_agg(printf('%02x', near.e), '' ORDER BY part) AS code, sum(near.d)::BIGINT AS error FROM a{cover_codes.ROUNDS} GROUP BY rn)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT sha256(string_agg(
    array_to_string(list_transform(x, lambda c: c::BIGINT::VARCHAR), ','), ',' ORDER BY part, entry)) FROM {books}) AS codebooks_sha256
FROM coded JOIN kept USING (rn)
"""


#: Levels that the SQL of the manifest unrolls: enough for eight to this power leaves a group.
SQL_LEVELS = 8


def _merkle_sql() -> str:
    f = merkle.FANOUT

    def levels(name: str, leaves: str) -> str:
        """Nodes (t, i, h) and runs (t, p, hs) of every level; ``n`` is the nodes of the tree at the level."""
        out = [f"{name}0 AS MATERIALIZED ({leaves})"]
        for k in range(SQL_LEVELS):
            out.append(f"""{name}r{k} AS MATERIALIZED (SELECT t, i // {f} AS p, list(h ORDER BY i) AS hs, max(n) AS n FROM {name}{k} WHERE n > 1 GROUP BY ALL)""")
            out.append(f"""{name}{k + 1} AS MATERIALIZED (SELECT t, p AS i, sha256(array_to_string(hs, '')) AS h, (n + {f - 1}) // {f} AS n
    FROM {name}r{k} UNION ALL SELECT t, i, h, n FROM {name}{k} WHERE n = 1)""")
        return ", ".join(out)

    def steps(name: str, tree: str, idx: str) -> tuple[str, list[str], list[str]]:
        joins = " ".join(f"LEFT JOIN {name}r{k} {name}j{k} ON {name}j{k}.t = {tree} AND {name}j{k}.p = {idx} // {f ** (k + 1)}" for k in range(SQL_LEVELS))
        slots = [f"({idx} // {f ** k} % {f})" for k in range(SQL_LEVELS)]
        left = [f"array_to_string({name}j{k}.hs[1:{s}], '')" for k, s in enumerate(slots)]
        right = [f"array_to_string({name}j{k}.hs[{s} + 2:], '')" for k, s in enumerate(slots)]
        return joins, left, right

    fields = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in merkle.FIELDS)
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    changed = fields.replace("text::VARCHAR", f"(CASE WHEN crc % 3 = 0 THEN {low} ELSE text END)")
    # CRC-32 bit by bit: each byte is met at its first of eight shifts.
    crc = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c:
        [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda a, b: CASE WHEN xor(a, b) % 2 = 1 THEN xor(xor(a, b) // 2, 3988292384) ELSE xor(a, b) // 2 END), 4294967295)"""
    joins, left, right = steps("g", "d.t", "d.i")
    more, upper_left, upper_right = steps("u", "0", "d.t")
    proof = " || ".join(f"coalesce({a} || {b}, '')" for a, b in zip(left + upper_left, right + upper_right, strict=True))
    path = ", ".join(f"{{'l': {a}, 'r': {b}}}" for a, b in zip(left + upper_left, right + upper_right, strict=True))
    start = "{'l': changed, 'r': ''}"
    return f"""
WITH read AS MATERIALIZED (SELECT *, {crc} AS crc FROM documents),
leaves AS MATERIALIZED (SELECT doc_id, lang, sha256({fields}) AS leaf, sha256({changed}) AS changed FROM read),
trees AS (SELECT lang, count(*) AS n, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS t FROM leaves GROUP BY lang),
placed AS MATERIALIZED (SELECT doc_id, t, n, leaf, changed, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
    FROM leaves l JOIN trees g ON l.lang IS NOT DISTINCT FROM g.lang),
{levels('g', 'SELECT t, i, leaf AS h, n FROM placed')},
{levels('u', f'SELECT 0 AS t, t AS i, h, (SELECT count(*) FROM trees) AS n FROM g{SQL_LEVELS}')},
found AS (SELECT doc_id, leaf, s.h AS subroot, r.h AS root, sha256({proof}) AS proof_sha256, list_reduce(list_filter([{path}], lambda s: s.l IS NOT NULL),
        lambda a, s: {{'l': sha256(s.l || a.l || s.r), 'r': ''}}, {start}).l AS folded_root
    FROM placed d JOIN g{SQL_LEVELS} s ON s.t = d.t CROSS JOIN u{SQL_LEVELS} r {joins} {more})
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM found
"""


ORACLES["op11_cover_codes"] = _cover_codes_sql()
ORACLES["op12_merkle"] = _merkle_sql()
ORACLES["op5_licenses"] = _licenses_sql()
ORACLES["op6_url_reputation"] = _reputation_sql()
ORACLES["op9_mixing"] = _mixing_sql()
