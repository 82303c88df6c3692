"""A small query language over documents, compiled to DataFrame transformations.

    SELECT [item, ...] FROM documents|authors|sources|attribution [[AS] name]
      [[LEFT] JOIN view [[AS] name] ON field = field [AND ...]]
      [WHERE condition] [GROUP BY field, ...] [HAVING condition] [ORDER BY field [ASC|DESC]] [LIMIT n|ALL]

An item is a field or COUNT(*), COUNT, SUM, AVG, MIN or MAX of a field, COUNT(DISTINCT field) too, with AS and a name; without items
all columns of the view are selected. COUNT of a field counts where it exists; SUM and AVG take texts as numbers. With a
join, `name.field` is a field of that side, and a bare field must be a column of one side only; the columns of an itemless
join are named `name_column`. HAVING and ORDER BY may use names of items.

A condition combines predicates with AND, OR, NOT and brackets; a predicate is `field op value` with = != > < >= <= ~,
`field [NOT] EXISTS`, `field [NOT] IN (a, b)` or `field BETWEEN a AND b`. Fields are columns of the view or keys of the
metadata map. Comparisons take the field's type, and a number makes a text field a number; a value that cannot be read as that
type matches nothing. Within quotes a backslash keeps the next character as it is. A missing
field equals nothing and differs from everything. Words of the language may name fields. Sorting comes before LIMIT
(100 unless given), with the id or group as the last key, and anything left over is an error.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("documents", "authors", "sources", "attribution")
LIMIT = 100


class QueryError(ValueError):
    """A text that is no query; the message has the position."""


@dataclass(frozen=True)
class Token:
    kind: str  # word, string, number, op, end
    text: str
    at: int


_TOKEN = re.compile(
    r"""(?P<space>[ \t\n]+)|(?P<string>"(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*')|(?P<number>-?\d[\d.]*)|(?P<word>[A-Za-z_][\w.]*)|(?P<op>!=|>=|<=|[=<>~(),*])""",
    re.S | re.A,
)


def tokens(text: str) -> list[Token]:
    out, at = [], 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise QueryError(f"unexpected {text[at]!r} at {at}")
        if m.lastgroup != "space":
            out.append(Token(m.lastgroup, m.group(), at))
        at = m.end()
    return [*out, Token("end", "", at)]


@dataclass(frozen=True)
class Predicate:
    field: str
    op: str
    values: tuple = ()


@dataclass(frozen=True)
class Group:
    op: str  # and, or, not
    parts: tuple


@dataclass(frozen=True)
class Item:
    field: str  # "*" in COUNT(*)
    name: str
    function: str | None = None  # count, count distinct, sum, avg, min, max


@dataclass(frozen=True)
class Join:
    kind: str
    name: str
    on: tuple[tuple[str, str], ...]
    outer: bool = False


@dataclass(frozen=True)
class Query:
    kind: str
    where: Predicate | Group | None = None
    order_by: str | None = None
    descending: bool = False
    limit: int | None = LIMIT  # None: all rows
    items: tuple[Item, ...] = ()
    name: str | None = None  # None: the view's own
    join: Join | None = None
    group: tuple[str, ...] = ()
    having: Predicate | Group | None = None


FUNCTIONS = ("count", "sum", "avg", "min", "max")


class _Parser:
    def __init__(self, text: str):
        self.tokens, self.at = tokens(text), 0

    @property
    def next(self) -> Token:
        return self.tokens[self.at]

    def word(self, *names: str) -> bool:
        """Takes the next word if it is one of these."""
        if self.next.kind == "word" and self.next.text.lower() in names:
            self.at += 1
            return True
        return False

    def need(self, what: str) -> None:
        if not (self.word(what) if what.isalpha() else self.sign(what)):
            raise QueryError(f"expected {what.upper()} at {self.next.at}")

    def sign(self, text: str) -> bool:
        if self.next.kind == "op" and self.next.text == text:
            self.at += 1
            return True
        return False

    def name(self) -> str:
        if self.next.kind != "word":
            raise QueryError(f"expected a field at {self.next.at}")
        self.at += 1
        return self.tokens[self.at - 1].text

    def ahead(self, *names: str) -> bool:
        return self.next.kind == "word" and self.next.text.lower() in names

    def view(self) -> tuple[str, str]:
        """A view and the name it goes by."""
        kind = self.name().lower()
        if kind not in KINDS:
            raise QueryError(f"unknown view {kind!r}")
        if self.word("as"):
            return kind, self.name()
        named = self.next.kind == "word" and not self.ahead("join", "left", "on", "where", "group", "having", "order", "limit")
        return kind, self.name() if named else kind

    def item(self) -> Item:
        following = self.tokens[self.at + 1] if self.next.kind == "word" else None
        if self.ahead(*FUNCTIONS) and following.text == "(":
            function = self.name().lower()
            self.need("(")
            if function == "count" and self.sign("*"):
                of, label = "*", "count"
            else:
                function += " distinct" if function == "count" and self.ahead("distinct") and self.tokens[self.at + 1].kind == "word" and self.word("distinct") else ""
                of = self.name()
                label = f"{function.split()[0]}_{of.rpartition('.')[2]}"
            self.need(")")
        else:
            function, of = None, self.name()
            label = of.rpartition(".")[2]
        return Item(of, self.name() if self.word("as") else label, function)

    def joined(self) -> Join | None:
        outer = self.ahead("left") and self.word("left")
        if not self.word("join"):
            if outer:
                raise QueryError(f"expected JOIN at {self.next.at}")
            return None
        kind, name = self.view()
        self.need("on")
        on = []
        while True:
            left = self.name()
            self.need("=")
            on.append((left, self.name()))
            if not self.word("and"):
                return Join(kind, name, tuple(on), bool(outer))

    def query(self) -> Query:
        self.need("select")
        items = []
        if not self.ahead("from") or self.tokens[self.at + 1].kind != "word":
            items.append(self.item())
            while self.sign(","):
                items.append(self.item())
        self.need("from")
        kind, name = self.view()
        join = self.joined()
        if join and join.name == name:
            raise QueryError(f"two views are named {name!r}")
        where = self.any_of() if self.word("where") else None
        group = []
        if self.word("group"):
            self.need("by")
            group.append(self.name())
            while self.sign(","):
                group.append(self.name())
        having = self.any_of() if self.word("having") else None
        if group or any(i.function for i in items):
            loose = [i.field for i in items if not i.function and i.field not in group]
            if loose or not items:
                raise QueryError(f"neither grouped nor counted: {', '.join(loose)}" if loose else "GROUP BY needs items")
        elif having:
            raise QueryError("HAVING needs groups")
        if len({i.name for i in items}) < len(items):
            raise QueryError("two items have one name")
        order, down, limit = None, False, LIMIT
        if self.word("order"):
            self.need("by")
            order = self.name()
            down = self.word("desc") or (self.word("asc") and False)
        if self.word("limit"):
            if self.word("all"):
                limit = None
            else:
                if self.next.kind != "number" or not re.fullmatch(r"\d+(\.0*)?", self.next.text):
                    raise QueryError(f"expected a whole number at {self.next.at}")
                limit = int(float(self.next.text))
                self.at += 1
        return self.finished(Query(kind, where, order, down, limit, tuple(items), None if name == kind else name, join, tuple(group), having))

    def finished(self, query: Query) -> Query:
        if self.next.kind != "end":
            raise QueryError(f"unexpected {self.next.text!r} at {self.next.at}")
        return query

    def any_of(self):
        parts = [self.all_of()]
        while self.word("or"):
            parts.append(self.all_of())
        return parts[0] if len(parts) == 1 else Group("or", tuple(parts))

    def all_of(self):
        parts = [self.one()]
        while self.word("and"):
            parts.append(self.one())
        return parts[0] if len(parts) == 1 else Group("and", tuple(parts))

    def one(self):
        if self.sign("("):
            inner = self.any_of()
            self.need(")")
            return inner
        if self.next.kind == "word" and self.next.text.lower() == "not" and self.tokens[self.at + 1].text == "(":
            self.at += 1
            return Group("not", (self.one(),))
        name = self.name()
        if self.word("exists"):
            return Predicate(name, "exists")
        if self.word("not"):
            if self.word("exists"):
                return Predicate(name, "not exists")
            self.need("in")
            return Predicate(name, "not in", self.listed())
        if self.word("in"):
            return Predicate(name, "in", self.listed())
        if self.word("between"):
            low = self.value()
            self.need("and")
            return Predicate(name, "between", (low, self.value()))
        if self.next.kind != "op" or self.next.text in "(),":
            raise QueryError(f"expected a comparison at {self.next.at}")
        op = self.next.text
        self.at += 1
        return Predicate(name, op, (self.value(),))

    def listed(self) -> tuple:
        self.need("(")
        values = [self.value()]
        while self.sign(","):
            values.append(self.value())
        self.need(")")
        return tuple(values)

    def value(self):
        t = self.next
        if t.kind not in ("string", "number", "word"):
            raise QueryError(f"expected a value at {t.at}")
        self.at += 1
        if t.kind == "string":
            return re.sub(r"\\(.)", r"\1", t.text[1:-1], flags=re.S)
        if t.kind == "number":
            try:
                return float(t.text) if "." in t.text else int(t.text)
            except ValueError:
                raise QueryError(f"no number: {t.text} at {t.at}") from None
        return {"true": True, "false": False}.get(t.text.lower(), t.text)


def parse(text: str) -> Query:
    return _Parser(text).query()


def shown(value: object) -> str:
    """A literal as text that reads back as the same value."""
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, str):
        return '"' + value.replace("\\", "\\\\").replace('"', '\\"') + '"'
    if not math.isfinite(value):
        raise QueryError(f"no literal: {value}")
    text = format(Decimal(repr(value)), "f")
    return text if isinstance(value, int) or "." in text else text + ".0"


def rendered(node: Predicate | Group) -> str:
    """A condition as text."""
    if isinstance(node, Group):
        parts = [f"({rendered(p)})" if isinstance(p, Group) or node.op == "not" else rendered(p) for p in node.parts]
        return f"NOT {parts[0]}" if node.op == "not" else f" {node.op.upper()} ".join(parts)
    if node.op in ("in", "not in"):
        return f"{node.field} {node.op.upper()} ({', '.join(map(shown, node.values))})"
    if node.op == "between":
        return f"{node.field} BETWEEN {shown(node.values[0])} AND {shown(node.values[1])}"
    return " ".join([node.field, node.op.upper(), *map(shown, node.values)])


@dataclass
class Builder:
    """Builds a query step by step: `Builder("documents").where("title", "~", "x").order_by("title").limit(5)`.

    `where` takes any number of values: one for a comparison, two for "between", a list's for "in", none for "exists".
    """

    kind: str = "documents"
    filters: list[Predicate | Group] = field(default_factory=list)
    order: tuple[str, bool] | None = None
    most: int | None = LIMIT

    def where(self, name: str, op: str, *values: object) -> Builder:
        self.filters.append(Predicate(name, op.lower(), values))
        return self

    def any_of(self, *choices: tuple) -> Builder:
        """At least one of some conditions, each given as `where` takes it."""
        parts = tuple(Predicate(name, op.lower(), tuple(values)) for name, op, *values in choices)
        self.filters.append(parts[0] if len(parts) == 1 else Group("or", parts))
        return self

    def none_of(self, *choices: tuple) -> Builder:
        self.any_of(*choices)
        self.filters.append(Group("not", (self.filters.pop(),)))
        return self

    def order_by(self, name: str, descending: bool = False) -> Builder:
        self.order = (name, descending)
        return self

    def limit(self, n: int | None) -> Builder:
        self.most = n
        return self

    def query(self) -> Query:
        where = None if not self.filters else self.filters[0] if len(self.filters) == 1 else Group("and", tuple(self.filters))
        return Query(self.kind, where, *(self.order or (None, False)), self.most)

    def text(self) -> str:
        q = self.query()
        out = f"SELECT FROM {q.kind}"
        if q.where is not None:
            out += f" WHERE {rendered(q.where)}"
        if q.order_by:
            out += f" ORDER BY {q.order_by} {'DESC' if q.descending else 'ASC'}"
        return out + (" LIMIT ALL" if q.limit is None else f" LIMIT {q.limit}" if q.limit > 0 else "")


#: Canned queries.
EXAMPLES = {
    "recent": "SELECT FROM documents ORDER BY created_at DESC LIMIT 10",
    "by source": 'SELECT FROM documents WHERE source = "src1"',
    "by title": 'SELECT FROM documents WHERE title ~ "the" LIMIT 20',
    "by author": 'SELECT FROM documents WHERE author = "Author 1"',
    "attributed": "SELECT FROM attribution WHERE attributed = true",
    "sources": "SELECT FROM sources ORDER BY count DESC",
    "authors": "SELECT FROM authors LIMIT 50",
}


# -- planning ---------------------------------------------------------------------------------------------------------


@dataclass
class Views:
    """The library's columns: id, source, url, title, author, authors, metadata, created_at, updated_at (any may be missing)."""

    library: DataFrame
    marker: str

    def resolver(self, df: DataFrame, prefix: str = "") -> Callable[[str], Column]:
        """What a field is among the columns of `df`, which go by their names with `prefix`."""

        def resolve(name: str) -> Column:
            if name == "author" and "authors" in df.columns and "author" in df.columns:
                return F.coalesce(F.nullif(F.col(f"{prefix}author"), F.lit("")), F.col(f"{prefix}authors"))
            if name in df.columns:
                return F.col(f"`{prefix}{name}`")
            if "metadata" in df.columns:
                return F.try_element_at(F.col(f"{prefix}metadata"), F.lit(name))
            return F.lit(None).cast("string")

        return resolve

    def attributed(self) -> Column:
        """Whether the attribution names the marker; without one, whether any metadata value does."""
        named = F.try_element_at("metadata", F.lit("attribution"))
        marked = lambda v: F.contains(F.lower(v), F.lit(self.marker.lower()))
        return F.coalesce(F.when(F.map_contains_key("metadata", "attribution"), marked(named)).otherwise(F.exists(F.map_values("metadata"), marked)), F.lit(False))

    def view(self, kind: str) -> tuple[DataFrame, list[Column]]:
        """The rows of a view and its order when none is asked for."""
        lib = self.library
        if kind == "documents":
            return lib, [F.col("id")]
        source = F.coalesce(F.nullif(F.col("source"), F.lit("")), F.lit("unknown"))
        if kind == "sources":
            return lib.groupBy(source.alias("source")).agg(F.count("*").alias("count")), [F.desc("count"), F.col("source")]
        if kind == "authors":
            names = F.filter(F.transform(F.split(F.coalesce("authors", F.lit("")), ","), lambda a: F.trim(a)), lambda a: a != "")
            first = F.nullif(F.coalesce("author", F.lit("")), F.lit(""))
            listed = F.when(first.isNull(), names).otherwise(F.concat(F.array(first), F.filter(names, lambda a: a != first)))
            grouped = lib.select(F.explode(listed).alias("author")).groupBy("author").agg(F.count("*").alias("document_count"))
            return grouped, [F.desc("document_count"), F.col("author")]
        order = F.struct("created_at", "id")
        grouped = lib.groupBy(source.alias("source")).agg(
            F.count("*").alias("document_count"), F.min("created_at").alias("first_seen"), F.max("created_at").alias("last_seen"),
            F.min_by(self.attributed(), order).alias("attributed"), F.max_by(F.try_element_at("metadata", F.lit("attribution")), order).alias("attribution"),
        )
        return grouped, [F.desc("document_count"), F.col("source")]


def _sides(f: Column, value: object, kind: T.DataType) -> tuple[Column, Column]:
    """The field and a literal in one type, the same for all comparisons; the literal is null where it cannot be read so.

    A number makes a text field a number. Elsewhere the field stays bare and the literal is read as its type.
    """
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return f, F.try_to_timestamp(F.lit(value)) if isinstance(value, str) else F.lit(None).cast("timestamp")
    if isinstance(kind, T.NumericType):
        return f, F.lit(value) if number else F.lit(value).try_cast("double") if isinstance(value, str) else F.lit(None).cast("double")
    if isinstance(kind, T.BooleanType):
        return f, F.lit(value) if isinstance(value, bool) else F.lit(None).cast("boolean")
    if number:
        whole = isinstance(value, int) and abs(value) < 1 << 63
        return (f.try_cast("decimal(38,10)"), F.lit(value).cast("decimal(38,10)")) if whole else (f.try_cast("double"), F.lit(float(value)))
    return f, F.lit(str(value).lower() if isinstance(value, bool) else value)


def condition(node: Predicate | Group | None, df: DataFrame, resolve: Callable[[str], Column]) -> Column:
    """The condition as a column, null counting as false; comparisons stay bare so that they reach the scan."""
    if node is None:
        return F.lit(True)
    if isinstance(node, Group):
        parts = [condition(p, df, resolve) for p in node.parts]
        return ~F.coalesce(parts[0], F.lit(False)) if node.op == "not" else reduce((lambda a, b: a & b) if node.op == "and" else (lambda a, b: a | b), parts)
    f = resolve(node.field)
    kind = df.select(f).schema[0].dataType
    present = (f.isNotNull() & (f != "")) if isinstance(kind, T.StringType) else f.isNotNull()
    if node.op in ("exists", "not exists"):
        return present if node.op == "exists" else ~present
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.lit(False)
    if node.op == "~":
        v = node.values[0]
        return F.contains(F.lower(f), F.lower(F.lit(v if isinstance(v, str) else shown(v)))) if isinstance(kind, T.StringType) else F.lit(False)
    pairs = [_sides(f, v, kind) for v in node.values]
    if node.op in ("in", "not in"):
        same = reduce(lambda a, b: a | b, [a == b for a, b in pairs])
        return same if node.op == "in" else ~F.coalesce(same, F.lit(False))
    if node.op == "between":
        (a, low), (b, high) = pairs
        return (a >= low) & (b <= high)
    a, b = pairs[0]
    if node.op == "!=":
        return F.coalesce(a != b, F.lit(True))
    return {"=": a == b, ">": a > b, "<": a < b, ">=": a >= b, "<=": a <= b}[node.op]


def _joined(q: Query, views: Views) -> tuple[DataFrame, list[Column], Callable[[str], Column]]:
    """The rows of two views joined, their natural order, and the meaning of a field: of one side by its name, or of the only side that has it."""
    sides, orders = {}, []
    for name, kind in ((q.name or q.kind, q.kind), (q.join.name, q.join.kind)):
        df, _ = views.view(kind)
        sides[name] = (df.select(*[F.col(f"`{c}`").alias(f"{name}_{c}") for c in df.columns]), df)
        orders.append(F.col(f"{name}_{'id' if kind == 'documents' else 'author' if kind == 'authors' else 'source'}"))

    def of(name: str, field_name: str) -> Column:
        _, plain = sides[name]
        return views.resolver(plain, f"{name}_")(field_name)

    def resolve(text: str) -> Column:
        name, dot, rest = text.partition(".")
        if dot and name in sides:
            return of(name, rest)
        having = [n for n, (_, plain) in sides.items() if text in plain.columns]
        if len(having) == 1:
            return of(having[0], text)
        with_metadata = [n for n, (_, plain) in sides.items() if "metadata" in plain.columns]
        if having or len(with_metadata) != 1:
            raise QueryError(f"which view's field is {text!r}?")
        return of(with_metadata[0], text)

    (left, _), (right, _) = sides.values()
    both = left.join(right, reduce(lambda a, b: a & b, [resolve(a) == resolve(b) for a, b in q.join.on]), "left" if q.join.outer else "inner")
    return both, orders, resolve


def _aggregated(item: Item, df: DataFrame, resolve: Callable[[str], Column]) -> Column:
    if item.field == "*":
        return F.count(F.lit(1)).alias(item.name)
    f = resolve(item.field)
    text = isinstance(df.select(f).schema[0].dataType, T.StringType)
    number = f.try_cast("double") if text else f
    made = {
        "count": lambda: F.count(F.nullif(f, F.lit("")) if text else f), "count distinct": lambda: F.count_distinct(F.nullif(f, F.lit("")) if text else f),
        "sum": lambda: F.sum(number), "avg": lambda: F.avg(number), "min": lambda: F.min(f), "max": lambda: F.max(f),
    }
    return made[item.function]().alias(item.name)


def plan(query: Query | str, views: Views) -> DataFrame:
    """The query's rows. Sorting and limiting together plan as one top-k; filters on one side of a join reach that side's scan."""
    q = parse(query) if isinstance(query, str) else query
    if q.join:
        df, natural, resolve = _joined(q, views)
    else:
        df, natural = views.view(q.kind)
        plain = views.resolver(df)
        resolve = lambda text: plain(text.removeprefix(f"{q.name or q.kind}."))
    df = df.where(condition(q.where, df, resolve))
    grouped = bool(q.group) or any(i.function for i in q.items)
    if grouped:
        kept = {g: next((i.name for i in q.items if i.field == g and not i.function), g.rpartition(".")[2]) for g in q.group}
        df = df.groupBy(*[resolve(g).alias(n) for g, n in kept.items()]).agg(*[_aggregated(i, df, resolve) for i in q.items if i.function])
        natural = [F.col(f"`{n}`") for n in kept.values()]
        inner, resolve = df, lambda text: F.col(f"`{kept.get(text, text)}`") if kept.get(text, text) in inner.columns else _unknown(text)
        df = df.where(condition(q.having, df, resolve))
    chosen = None if not q.items else [F.col(f"`{kept[i.field]}`" if not i.function else f"`{i.name}`") for i in q.items] if grouped else [resolve(i.field).alias(i.name) for i in q.items]
    order = natural
    if q.order_by:
        named = next((i for i in q.items if i.name == q.order_by and not i.function), None)
        f = resolve(named.field) if named and not grouped else resolve(q.order_by)
        f = F.coalesce(f, F.lit("")) if isinstance(df.select(f).schema[0].dataType, T.StringType) else f
        last = [F.col("id")] if q.kind == "documents" and not q.join and not grouped else natural if q.join or grouped else natural[-1:]
        order = [f.desc() if q.descending else f.asc(), *last]
    ordered = df.orderBy(*order) if order else df
    limited = ordered if q.limit is None else ordered.limit(q.limit)
    return limited if chosen is None else limited.select(*chosen)


def _unknown(text: str) -> Column:
    raise QueryError(f"neither grouped nor counted: {text}")
