"""Training records from documents: sections, picks, keywords, formats and conversations; all with built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as t

# Terms looked for in texts, and stop words of titles.
TERMS = [
    "go", "golang", "package", "function", "module", "interface", "struct", "error", "test",
]
STOP = ["the", "and", "for"]
CODE = [r"func\s+\w+[^\n]*\{[^}]*\}", r"package\s+\w+", r"import\s*\([^)]*\)", r"var\s+\w+[^\n]*=", r"type\s+\w+\s+struct"]


# What marks code, texts on Go, and topics worth a critical discussion.
CODE_MARKS = ["func ", "package ", "import ", "var ", "const ", "type ", "struct {", "interface {"]
GO_MARKS = ["golang", "go lang", "func main", "package main", "import", "goroutine"]
COMPLEX_DOMAINS = ["Philosophy", "Science", "Technology", "Economics"]
COMPLEX_WORDS = ["artificial intelligence", "machine learning", "ethics", "philosophy", "quantum", "evolution", "consciousness"]


def has_code(c: Column) -> Column:
    return t.has_any(F.lower(c), CODE_MARKS)


def on_go(c: Column) -> Column:
    return t.has_any(F.lower(c), GO_MARKS)


def is_complex(domain: Column, title: Column) -> Column:
    return domain.isin(*COMPLEX_DOMAINS) | t.has_any(F.lower(title), COMPLEX_WORDS)


def sanitized(c: Column, trimmed: bool = False) -> Column:
    out = F.lower(F.regexp_replace(c, "[^a-zA-Z0-9_-]", "_"))
    return F.left(F.btrim(out, F.lit("_")), F.lit(50)) if trimmed else out


def sections(c: Column, size: int = 400, least: int = 50) -> Column:
    """Lines gathered greedily into sections of over `size` bytes; pieces of at most `least` bytes are carried on, or dropped at the end.

    The walk over the lines keeps byte counts only: of the piece so far, and of what lies before and after its outermost words.
    """
    measured = F.transform(t.lines(c), lambda x: F.struct(
        x.alias("line"), F.octet_length(x).alias("n"), F.octet_length(F.ltrim(x, F.lit(t.UNICODE_SPACES))).alias("left"), F.octet_length(t.trim(x)).alias("bare"),
    ))
    none = F.lit(-1)
    zero = F.struct(F.lit(1).alias("from"), F.lit(0).alias("lines"), F.lit(0).alias("n"), none.alias("first"), F.lit(0).alias("last"), F.array().cast("array<struct<from:int,lines:int>>").alias("done"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["n"] + x["n"] - x["left"]
        first = F.when((acc["first"] < 0) & (x["bare"] > 0), start).otherwise(acc["first"])
        last = F.when(x["bare"] > 0, start + x["bare"]).otherwise(acc["last"])
        n, count = acc["n"] + x["n"] + 1, acc["lines"] + 1
        full = (n > size) & ((x["line"] == "") | (F.size(acc["done"]) < 10)) & (last - first > least) & (first >= 0)
        piece = F.array(F.struct(acc["from"].alias("from"), count.alias("lines")))
        return F.when(full, F.struct((acc["from"] + count).alias("from"), F.lit(0).alias("lines"), F.lit(0).alias("n"), none.alias("first"), F.lit(0).alias("last"), F.concat(acc["done"], piece).alias("done"))).otherwise(
            F.struct(acc["from"].alias("from"), count.alias("lines"), n.alias("n"), first.alias("first"), last.alias("last"), acc["done"].alias("done")))

    def finish(acc: Column) -> Column:
        rest = (acc["first"] >= 0) & (acc["last"] - acc["first"] > least)
        return F.when(rest, F.concat(acc["done"], F.array(F.struct(acc["from"].alias("from"), acc["lines"].alias("lines"))))).otherwise(acc["done"])

    pieces = F.aggregate(measured, zero, step, finish)
    return F.transform(pieces, lambda p: t.trim(F.array_join(F.slice(t.lines(c), p["from"], p["lines"]), "\n")))


def overview(c: Column, low: int = 50, high: int = 300, prefix: int = 200) -> Column:
    """The first paragraph of a length between, else the beginning of the text."""
    paras = F.filter(F.transform(t.paragraphs(c), t.trim), lambda p: (F.octet_length(p) > low) & (F.octet_length(p) < high))
    return F.coalesce(F.get(paras, F.lit(0)), F.when(F.octet_length(c) > prefix, F.concat(F.left(c, F.lit(prefix)), F.lit("..."))).otherwise(c))


def first_with(c: Column, words: list[str], low: int, high: int, fallback: str) -> Column:
    paras = F.filter(F.transform(t.paragraphs(c), t.trim), lambda p: (F.octet_length(p) > low) & (F.octet_length(p) < high) & t.has_any(F.lower(p), words))
    return F.coalesce(F.get(paras, F.lit(0)), F.lit(fallback))


def window_after(c: Column, word: str, n: int) -> Column:
    at = F.locate(word.lower(), F.lower(c))
    return F.when(at > 0, c.substr(at, F.lit(n)))


def key_points(c: Column, most: int = 7) -> Column:
    """Lines of 21 to 149 bytes with a colon or a bullet."""
    kept = F.filter(F.transform(t.lines(c), t.trim), lambda x: (F.octet_length(x) > 20) & (F.octet_length(x) < 150) & (t.has(x, ":") | F.startswith(x, F.lit("- ")) | F.startswith(x, F.lit("* "))))
    return F.slice(F.transform(kept, lambda x: F.concat(F.lit("• "), x)), 1, most)


def code_examples(c: Column, each: int = 3) -> Column:
    found = [F.slice(F.regexp_extract_all(c, F.lit(p), F.lit(0)), 1, each) for p in CODE]
    return F.filter(F.transform(F.slice(F.concat(*found), 1, each), t.trim), lambda x: (F.octet_length(x) > 10) & (F.octet_length(x) < 200))


def keywords(title: Column, c: Column, terms: list[str] = TERMS) -> Column:
    """Words of the title, then the terms that occur in the text; a missing title or text has none."""
    names = F.transform(t.fields(t.lower_each(title)), lambda w: F.btrim(w, F.lit(".,!?()[]{}:;\"'")))
    named = F.filter(names, lambda w: (F.octet_length(w) > 2) & ~w.isin(*STOP))
    found = t.bound(F.lower(F.replace(c, F.lit("İ"), F.lit("i"))), lambda low: F.array_compact(F.array(*[F.when(t.has(low, x), F.lit(x)) for x in terms])))
    return F.concat(F.coalesce(named, F.array().cast("array<string>")), found)


def formats(domain: Column, category: Column, c: Column, n_sections: Column) -> Column:
    """The conversation formats a document is worth, two to twelve."""
    coding = domain.isin("Programming", "CS") | t.has_any(c, ["function", "algorithm"])
    rules = [
        (F.lit(True), ["explanation", "qa"]), (coding, ["code_example", "tutorial", "best_practices"]), (t.has_any(c, ["theorem", "principle"]) | (category == "Theory"), ["deep_dive"]),
        (domain.isin("DevOps", "Web", "Cloud"), ["step_by_step", "troubleshooting"]), (t.has_any(c, ["advantage", "disadvantage", "versus", "compared"]), ["comparison"]),
        (n_sections > 5, ["interview", "case_study"]), ((domain == "AI") | (category == "Architecture"), ["debate"]),
    ]
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for cond, names in rules for name in names]))


#: Conversations made of each document: kind, question and answer, with {title}, {lower}, {overview}, {points} and {words}.
RECIPES = (
    ("overview", "What does {title} cover?", "Here's what it covers:\n\n{overview}"),
    ("detailed_explanation", "I need detailed information about {lower}. What are the key concepts?", "{overview}\n\nIn all there are {words} words."),
    ("quick_reference", "Give me a quick reference for {title}.", "Here's a quick reference for {title}:\n\n{points}"),
)


def filled(template: str, values: dict[str, Column]) -> Column:
    out, rest = [], template
    while "{" in rest:
        before, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        out += [F.lit(before), values[name]]
    return F.concat(*out, F.lit(rest))


def conversations_of(docs: DataFrame, ident: str = "id", title: str = "title", text: str = "text", recipes: tuple = RECIPES) -> DataFrame:
    """One row per document and recipe: id, kind, conversation (array of role and content)."""
    c = F.col(text)
    values = {"title": F.col(title), "lower": F.lower(title), "overview": overview(c), "points": F.array_join(key_points(c), "\n"), "words": t.word_count(c).cast("string")}
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    made = [F.struct(F.concat(sanitized(F.col(title)), F.lit(f"_{kind}_"), F.col(ident)).alias("conversation_id"), F.lit(kind).alias("kind"), F.array(turn("user", filled(q, values)), turn("assistant", filled(a, values))).alias("conversation")) for kind, q, a in recipes]
    return docs.select(F.col(ident), F.inline(F.array(*made)))


def summary(conversations: DataFrame) -> DataFrame:
    """Conversations, turns and characters of answers by kind."""
    turns = F.aggregate("conversation", F.lit(0).cast("long"), lambda a, x: a + F.length(x["content"]))
    return conversations.groupBy("kind").agg(F.count("*").alias("conversations"), F.sum(F.size("conversation")).alias("turns"), F.sum(turns).alias("chars"))


def summaries(conversations: DataFrame, fields: list[str]) -> DataFrame:
    """field, value, conversations, turns, chars and mean turns by each of some columns, and in all (field `all`), in one pass."""
    chars = F.aggregate("conversation", F.lit(0).cast("long"), lambda a, x: a + F.length(x["content"]))
    each = F.array(F.struct(F.lit("all").alias("field"), F.lit("").alias("value")), *[F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f).cast("string"), F.lit("unknown")).alias("value")) for f in fields])
    rows = conversations.select(F.size("conversation").alias("n"), chars.alias("chars"), F.explode(each).alias("by")).select("by.*", "n", "chars")
    return rows.groupBy("field", "value").agg(F.count("*").alias("conversations"), F.sum("n").alias("turns"), F.sum("chars").alias("chars"), F.round(F.avg("n"), 6).alias("mean_turns"))


def model_metrics(results: DataFrame, model: str, ok: Column, score: Column, millis: Column, tier: Column) -> DataFrame:
    """Requests, success rate, mean score and time of the successful ones, and their tiers, of each model.

    The rate is of the model's own requests, so it never exceeds 1.
    """
    tiers = [F.count_if(ok & (tier == x)).alias(x) for x in ("premium", "high", "medium", "low", "reject")]
    return results.groupBy(model).agg(
        F.count("*").alias("requests"), F.count_if(ok).alias("successful"), F.round(F.avg(ok.cast("double")), 6).alias("success_rate"),
        F.round(F.avg(F.when(ok, score)), 6).alias("quality"), F.round(F.avg(F.when(ok, millis)), 6).alias("millis"), *tiers,
    )


def retry_schedule(failures: Column, first: float, factor: float, most: int) -> Column:
    """The seconds waited before each further attempt, `first` times powers of `factor`, for a number of failures; at most `most` of them."""
    n = F.least(failures, F.lit(most)).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.lit(first) * F.pow(F.lit(factor), i))).otherwise(F.array().cast("array<double>"))


def best_model(requests: DataFrame, models: DataFrame, key: str = "request_id") -> DataFrame:
    """The best model for each request: needed capabilities .3 each, success and quality .25, cheapness .2, times a weight.

    `models` is a small configuration table (name, capabilities, success_rate, quality, cost, weight, usable); it is folded
    into one array literal's worth of rows, so requests are neither multiplied nor shuffled.
    """
    listed = models.where("usable").agg(F.collect_list(F.struct("name", "capabilities", "success_rate", "quality", "cost", "weight")).alias("_models"))

    def score(m: Column) -> Column:
        needed = F.size(F.array_intersect(m["capabilities"], F.col("needs"))) * 0.3
        cheap = F.when(m["cost"] > 0, 0.2 / (1.0 + m["cost"] * 100)).otherwise(0.0)
        return (needed + m["success_rate"] * 0.25 + m["quality"] * 0.25 + cheap) * m["weight"]

    ranked = F.array_sort(F.transform("_models", lambda m: F.struct((-F.round(score(m), 9)).alias("s"), m["name"].alias("name"))))
    return requests.join(F.broadcast(listed)).select(key, F.get(ranked, F.lit(0))["name"].alias("model"), (-F.get(ranked, F.lit(0))["s"]).alias("score"))
