"""Secret scans over a trigram inverted index, with DataFrame functions only.

From each rule's regular expression a Boolean trigram query is derived. The index holds, for every trigram that some rule asks for, the
texts that have it. Intersecting the postings of a rule's trigrams gives the texts that may match; only these are verified
with the expression. Rules without a mandatory trigram scan every text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.trigrams import query_of, trigrams


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int = 1  # code points that the checked group needs; shorter matches are dropped, and use up their text all the same
    group: int = 0
    gate: str | None = None  # for rules that scan every text: a cheaper expression that every kept match has to fulfil


# A private key: its header, then all up to the END line, or, with no END line before other dashes, header fields and the base64 run that follows. What
# stands between two chunks of the run are spaces and line ends, also written as escapes, and the signs of quotes, lists and comments.
_BEGIN, _END = [rf"-----{word} [A-Z0-9 ]{{0,40}}PRIVATE KEY(?: BLOCK)?-----" for word in ("BEGIN", "END")]
_BETWEEN = r"""(?:\s|\\[nrt]|["'>+,#*|])"""
_FIELD = r"(?:Proc-Type:\x20*[0-9],ENCRYPTED|DEK-Info:\x20*[A-Za-z0-9-]++,[0-9A-Fa-f]++|(?:Version|Comment|Hash|Charset|MessageID):[^\r\n]{0,200}?(?=[\r\n]|(?:\x20|\\[nr])+[A-Za-z0-9+/]{40}))"
_CHUNKS = rf"(?:{_BETWEEN}*+[A-Za-z0-9+/=]{{16,}}+)++"
# After whole chunks, if they do not end with padding, one short rest, whatever it is; then a checksum.
_RUN = rf"(?:{_BETWEEN}*+{_FIELD})*+(?:{_CHUNKS}(?:(?<!=){_BETWEEN}++[A-Za-z0-9+/]++={{0,2}})?+(?:{_BETWEEN}*+=[A-Za-z0-9+/]{{4}})?+)?+"
PRIVATE_KEY = rf"{_BEGIN}(?:(?:[^-]++|-(?!----))*+{_END}|{_RUN})"

# In the order in which spans with the same start are listed.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]+", 32, gate=r"[0-9a-f]{32}"),
    Rule("private_key", PRIVATE_KEY),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("code_host_2", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("package_host", r"npm_[A-Za-z0-9]{36}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", r"(?i)bearer\x20+[A-Za-z0-9._~+/-]{16,}=*"),
    Rule("storage_key", r"AccountKey=[A-Za-z0-9+/]{40,}=*"),
    # Keywords of assign with something behind them: secret_access_key, SECRET_KEY, secretKey, token-value.
    Rule("assign_more", r"""((?i:password|passwd|secret|token|api_?key)(?:[_.-][A-Za-z0-9]{1,30}|[A-Z][A-Za-z0-9]{0,30}|(?i:key))(?:[_.-][A-Za-z0-9]{1,30}){0,4}["']?[\x20\t]*(?:[:=]=?|=>)[\x20\t]*["']?)([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("temporary_access", r"(?<![A-Za-z0-9])ASIA[A-Z0-9]+", 16),
    Rule("address", r"""://[^\s/:@"'<>]*:[^\s/"'<>]+@(?=[A-Za-z0-9\[])"""),
)
SPAN = "struct<kind:string,start:bigint,end:bigint>"


def index(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Postings ``(gram, key)`` of ``texts(key, text)``: of each text the trigrams, in lower case, that some rule asks for."""
    grams = sorted({g for r in rules for strings in query_of(r.pattern) for s in strings for g in trigrams(s)})
    low = texts.select("key", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    return low.select("key", F.explode(held).alias("gram"))


def candidates(postings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``key`` and the kinds of the rules whose trigram query the text fulfils."""
    queries = {r.kind: query_of(r.pattern) for r in rules}
    strings = sorted({s for q in queries.values() for alternative in q for s in alternative})
    # One row per string and trigram: a table as large as the rules, whatever the input is.
    asked = [(s, g, len(trigrams(s))) for s in strings for g in sorted(trigrams(s))]
    table = F.broadcast(postings.sparkSession.createDataFrame(asked, "string string, gram string, asked int"))
    found = postings.join(table, "gram").groupBy("key", "string").agg(F.countDistinct("gram").alias("n"), F.first("asked").alias("asked")).where("n = asked")
    per_key = found.groupBy("key").agg(F.collect_set("string").alias("strings"))  # as many as the rules have strings at most
    kinds = []
    for kind, query in queries.items():
        if query:
            fulfilled = F.lit(True)
            for alternative in query:
                fulfilled = fulfilled & F.arrays_overlap("strings", F.array(*[F.lit(s) for s in sorted(alternative)]))
            kinds.append(F.when(fulfilled, F.lit(kind)))
    return per_key.select("key", F.array_compact(F.array(*kinds)).alias("kinds")).where(F.size("kinds") > 0)


def spans_of(text: Column, rule: Rule) -> Column:
    """Kept matches of a rule, leftmost first and not overlapping, in code points with the end exclusive.

    Cutting the text at the matches gives what lies between them; lengths added up give the places.
    """
    between = F.split(text, rule.pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    checked = matches if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    parts = F.arrays_zip(between.alias("gap"), matches.alias("match"), checked.alias("checked"))
    nothing = F.struct(F.lit(0).cast("bigint").alias("at"), F.expr(f"cast(array() as array<{SPAN}>)").alias("spans"))

    def step(so_far: Column, part: Column) -> Column:
        start = so_far["at"] + F.char_length(part["gap"])
        end = start + F.coalesce(F.char_length(part["match"]), F.lit(0))
        span = F.struct(F.lit(rule.kind).alias("kind"), start.alias("start"), end.alias("end"))
        kept = F.char_length(part["checked"]) >= rule.least
        return F.struct(end.alias("at"), F.when(kept, F.concat(so_far["spans"], F.array(span))).otherwise(so_far["spans"]).alias("spans"))

    return F.aggregate(parts, nothing, step, lambda done: done["spans"])


def find_secrets(docs: DataFrame, text: str = "text", key: str | None = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All rows and columns, with ``secrets``: an array of (kind, start, end) by start, then by the order of the rules.

    A NULL text counts as empty and has no secrets. Rows are told apart by a hash of key and text, so repeated rows get the same spans; were
    two hashes equal, both rows would be verified against the candidates of either. A column named ``secrets`` is replaced.
    """
    fields = [F.col(f"`{c}`") for c in docs.columns if c != "secrets"]
    told = [F.col(c) for c in (key, text) if c is not None]
    rows = docs.select(F.struct(*fields).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.xxhash64(*told).alias("key"))
    wanted = candidates(index(rows.select("key", "text"), rules), rules)
    marked = rows.join(wanted, "key", "left")
    nothing = F.expr(f"cast(array() as array<{SPAN}>)")
    found = []
    for rule in rules:
        scans = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False)) if query_of(rule.pattern) else F.col("text").rlike(rule.gate or rule.pattern)
        found.append(F.when(scans, spans_of(F.col("text"), rule)).otherwise(nothing))
    place = {r.kind: i for i, r in enumerate(rules)}
    rank = F.create_map(*[F.lit(x) for item in place.items() for x in item])
    # Start, then rank of the kind, then the rest: the natural order of a struct.
    ordered = F.array_sort(F.transform(F.concat(*found), lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return marked.select("row.*", F.transform(ordered, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("secrets"))


def redacted(text: Column, secrets: Column, mark: str = "[SECRET]") -> Column:
    """The text with every stretch covered by secrets replaced by one mark; spans that overlap or touch make one stretch."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(so_far: Column, span: Column) -> Column:
        gap = F.substring(text, (so_far["at"] + 1).cast("int"), (span["start"] - so_far["at"]).cast("int"))
        fresh = (span["start"] > so_far["at"]) | (so_far["at"] == 0) & (so_far["out"] == "")
        out = F.when(fresh, F.concat(so_far["out"], gap, F.lit(mark))).otherwise(so_far["out"])
        return F.struct(F.greatest(so_far["at"], span["end"]).alias("at"), out.alias("out"))

    whole = F.aggregate(secrets, start, step, lambda done: F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    return F.when(F.size(secrets) > 0, whole).otherwise(text)
