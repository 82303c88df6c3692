"""Code blocks and formulas in texts: extraction and heuristic validation, as columns. Nothing is ever compiled or run."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions import text as t

# Patterns by language that show valid syntax, and that are unsafe.
SYNTAX = {
    "go": [r"^package\s+\w+", r"func\s+\w+\s*\("],
    "python": [r"def\s+\w+\s*\(", r"class\s+\w+"],
    "javascript": [r"function\s+\w+\s*\(", r"=>\s*\{", r"var\s+\w+|let\s+\w+|const\s+\w+"],
    "java": [r"public\s+class\s+\w+", r"public\s+static\s+void\s+main"],
}
UNSAFE = {
    "go": [r"os\.Exec", r"exec\.Command", r"syscall\.", r"unsafe\.", r"os\.Remove", r"os\.RemoveAll", r"ioutil\.WriteFile"],
    "python": [r"import\s+os", r"import\s+subprocess", r"import\s+sys", r"exec\s*\(", r"eval\s*\(", "__import__"],
    "javascript": [r"require\s*\(\s*['\"]fs['\"]", r"require\s*\(\s*['\"]child_process['\"]", r"eval\s*\(", r"Function\s*\(", r"new\s+Function"],
    "java": [r"Runtime\.getRuntime", "ProcessBuilder", r"System\.exit", "File", "FileInputStream", "FileOutputStream"],
}
UNSAFE_ANYWHERE = [r"rm\s+-rf", r"del\s+/", r"format\s+c:", r"while\s*\(\s*true\s*\)", r"for\s*\(\s*;\s*;\s*\)", "http://", "https://"]
DANGEROUS = [
    "system(", "exec(", "shell_exec(", "passthru(", "popen(", "proc_open(", "file_get_contents(", "file_put_contents(", "fopen(", "fwrite(", "curl_exec(", "eval(", "__import__",
    "getattr(", "setattr(", "delattr(", "compile(", "os.system", "os.popen", "subprocess", "runtime.exec", "require('child_process')", "require('fs')", "require('os')",
    "process.start", "processbuilder", "runtime.getruntime",
]
DANGEROUS_IMPORTS = {"python": ["import os", "import subprocess", "import sys", "__builtins__"], "javascript": ["new function("], "go": ["os/exec", "syscall", "unsafe"]}
HANDLING = {"go": ["if err != nil", "error"], "python": ["try:", "except"], "javascript": ["try {", "catch"], "java": ["try {", "catch"]}

# What a formula may hold, and what is wrong in one.
FUNCTIONS = ["sin", "cos", "tan", "asin", "acos", "atan", "log", "ln", "exp", "sqrt", "abs", "floor", "ceil", "round", "max", "min", "sum", "prod"]
CONSTANTS = ["pi", "e", "phi"]
OPERATORS = ["+", "-", "*", "/", "%", "^", "**"]
SYMBOLS = {"×": "*", "⋅": "*", "∙": "*", "÷": "/", "²": "^2", "³": "^3", "√": "sqrt", "∞": "inf", "±": "+-", "≤": "<=", "≥": ">=", "≠": "!="}
WRONG = [r"\b0/0\b", r"[0-9]+\s*/\s*0\b", r"log\(0\)", r"log\(-[0-9]+\)", r"sqrt\(-[0-9]+\)", r"\(\s*\)", r"[+\-*/^]{2,}"]
REDUNDANT = [r"\+ 0\b", r"- 0\b", r"\* 1\b", r"/ 1\b", r"\^ 1\b"]


def one_of(patterns: list[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def matches(c: Column, patterns: list[str]) -> Column:
    return F.regexp_like(c, F.lit(one_of(patterns)))


def by_language(language: Column, of: dict[str, Column], other: Column) -> Column:
    out = other
    for name, c in of.items():
        out = F.when(language == name, c).otherwise(out)
    return out


def code_blocks(c: Column) -> Column:
    """Fenced blocks as an array of (language, code); no language means text."""
    fence = F.lit(r"```(\w*)\n([\s\S]*?)\n```")
    pairs = F.arrays_zip(F.regexp_extract_all(c, fence, F.lit(1)).alias("language"), F.regexp_extract_all(c, fence, F.lit(2)).alias("code"))
    return F.transform(pairs, lambda p: F.struct(F.when(p["language"] == "", "text").otherwise(p["language"]).alias("language"), p["code"].alias("code")))


def formulas(c: Column) -> Column:
    """Inline and display formulas and equation environments, trimmed."""
    found = [F.regexp_extract_all(c, F.lit(p), F.lit(1)) for p in (r"\$([^$]+)\$", r"\$\$([^\$]+)\$\$", r"\\begin\{equation\}(.*?)\\end\{equation\}")]
    return F.transform(F.concat(*found), t.trim)


def balanced(c: Column, opening: str, closing: str) -> Column:
    """Whether brackets never close too early and all close: only brackets are kept, then folded."""
    marks = F.split(F.regexp_replace(c, f"[^{re.escape(opening + closing)}]", ""), "")
    start = F.struct(F.lit(0).alias("open"), F.lit(True).alias("ok"))

    def step(acc: Column, x: Column) -> Column:
        n = acc["open"] + F.when(x == opening, 1).when(x == closing, -1).otherwise(0)
        return F.struct(n.alias("open"), (acc["ok"] & (n >= 0)).alias("ok"))

    return F.aggregate(marks, start, step, lambda acc: acc["ok"] & (acc["open"] == 0))


def code_danger(code: Column, language: Column, low: Column | None = None) -> Column:
    """What forbids looking further; null if nothing does. `low` is the code in lower case where it is known already."""
    low = F.lower(code) if low is None else low
    general = F.lit(None).cast("string")
    for d in reversed(DANGEROUS):
        general = F.when(t.has(low, d), F.lit(f"dangerous code pattern detected: {d}")).otherwise(general)
    special = by_language(F.lower(language), {k: F.when(t.has_any(low, v), F.lit(f"dangerous {k} imports detected")) for k, v in DANGEROUS_IMPORTS.items()}, F.lit(None).cast("string"))
    return F.when(t.size_of(code) > 1 << 20, "code too large").otherwise(F.coalesce(general, special))


def code_syntax(code: Column, language: Column) -> Column:
    braces = balanced(code, "{", "}")
    fallback = {
        "go": ~(t.has(code, "fmt.Println") & ~t.has(code, "import")) & balanced(code, "(", ")") & t.has(code, "package ") & braces,
        "python": F.lit(True), "javascript": braces, "java": t.has(code, "class ") & braces,
    }
    return (t.trim(code) != "") & by_language(language, {k: matches(code, SYNTAX[k]) | f for k, f in fallback.items()}, F.lit(False))


def code_safe(code: Column, language: Column) -> Column:
    return ~(by_language(language, {k: matches(code, v) for k, v in UNSAFE.items()}, F.lit(False)) | matches(F.lower(code), UNSAFE_ANYWHERE))


def best_practices(code: Column, language: Column) -> Column:
    """Comments .2, names .3, indentation .2 (which cannot fail), lines of at most 120 bytes .15, error handling .15; 0.6 is enough."""
    flag = lambda cond, x: F.when(cond, x).otherwise(0.0)
    declared = F.filter(t.lines(code), lambda x: t.has_any(x, ["var ", "let ", "const ", ":="]))
    named = F.filter(declared, lambda x: F.exists(t.fields(x), lambda w: (F.octet_length(w) > 1) & ~F.contains(F.lit("var let const :="), w)))
    handled = by_language(language, {k: t.has_any(code, v) for k, v in HANDLING.items()}, F.lit(True))
    score = (
        flag(t.has_any(code, ["//", "/*", "#"]), 0.2) + flag((F.size(declared) > 0) & (F.size(named) > 0.8 * F.size(declared)), 0.3) + F.lit(0.2)
        + flag(~F.exists(t.lines(code), lambda x: F.octet_length(x) > 120), 0.15) + flag(handled, 0.15)
    )
    return F.round(score, 6) >= 0.6


def validated_code(code: Column, language: Column) -> dict[str, Column]:
    """syntax_valid, security_safe, best_practices, error; a danger or an unknown language stops at once. compilable stays null."""
    danger = code_danger(code, language)
    stop = F.coalesce(danger, F.when(~language.isin(*SYNTAX), F.concat(F.lit("Language '"), language, F.lit("' not supported for validation"))))
    go = stop.isNull()
    return {
        "syntax_valid": go & code_syntax(code, language), "security_safe": go & code_safe(code, language), "best_practices": go & best_practices(code, language),
        "compilable": F.lit(None).cast("boolean"), "error": stop,
    }


def normalized_formula(c: Column) -> Column:
    c = t.collapse(c)
    for symbol, ascii_ in SYMBOLS.items():
        c = F.replace(c, F.lit(symbol), F.lit(ascii_))
    return c


def notation(c: Column) -> Column:
    return F.when(t.has_any(c, ["\\", "{", "}"]), "latex").when(F.regexp_like(c, F.lit("[∑∏∫∞π√±×÷≤≥≠≈]")), "unicode").otherwise("ascii")


def formula_syntax(c: Column) -> Column:
    operators = ~F.regexp_like(c, F.lit(r"^[+*/%^]|[+\-*/%^]$|[+\-*/%^]{2,}"))
    called = ~F.regexp_like(c, F.lit(f"(?:{one_of(FUNCTIONS)})\\b *(?:[^( a-zA-Z0-9_]|$)|(?:{one_of(FUNCTIONS)}) +[^( ]"))
    return balanced(c, "(", ")") & operators & called & ~matches(c, WRONG)


def formula_semantics(c: Column) -> Column:
    def arguments(name: str) -> Column:
        return F.transform(F.regexp_extract_all(c, F.lit(name + r"\s*\(\s*([^)]+)\s*\)"), F.lit(1)), lambda a: t.trim(a).try_cast("double"))

    return ~F.exists(arguments("log"), lambda x: F.coalesce(x <= 0, F.lit(False))) & ~F.exists(arguments("sqrt"), lambda x: F.coalesce(x < 0, F.lit(False)))


def formula_consistency(c: Column) -> Column:
    sides = F.split(c, "=")
    equation = (F.size(sides) == 2) & (t.trim(F.get(sides, F.lit(0))) != "") & (t.trim(F.get(sides, F.lit(1))) != "")
    return ~t.has_any(c, ["1 = 0", "0 = 1"]) & ~matches(c, REDUNDANT) & (~t.has(c, "=") | equation)


def complexity(c: Column) -> Column:
    """Operators + twice the function names (as substrings) + opening brackets + variables + numbers."""
    count = lambda s: t.occurrences(c, F.lit(s))
    total = count("(")
    for o in OPERATORS:
        total = total + count(o)
    for f in FUNCTIONS:
        total = total + 2 * count(f)
    names = F.filter(F.regexp_extract_all(c, F.lit("([a-zA-Z]+)"), F.lit(1)), lambda w: ~w.isin(*FUNCTIONS, *CONSTANTS))
    return (total + F.size(names) + F.regexp_count(c, F.lit(r"[0-9]+\.?[0-9]*"))).cast("long")


def _confidence(syntax: Column, semantics: Column, consistency: Column, size: Column) -> Column:
    flag = lambda cond, x: F.when(cond, x).otherwise(0.0)
    return F.round((flag(syntax, 0.4) + flag(semantics, 0.3) + flag(consistency, 0.2)) * F.when(size > 100, 0.7).when(size > 50, 0.9).otherwise(1.0), 9)


def validated_formula(raw: Column) -> dict[str, Column]:
    c = normalized_formula(raw)
    syntax, semantics, consistency, size = formula_syntax(c), formula_semantics(c), formula_consistency(c), complexity(c)
    confidence = _confidence(syntax, semantics, consistency, size)
    empty = t.trim(raw) == ""
    said = F.concat_ws("; ", F.concat(F.lit("Notation: "), notation(c)), F.when(~syntax, "syntax errors"), F.when(~semantics, "semantic errors"), F.when(~consistency, "inconsistent"))
    return {
        "valid": ~empty & syntax & semantics & consistency & (confidence >= 0.6), "confidence": F.when(empty, 0.0).otherwise(confidence), "notation": notation(c),
        "complexity": size, "explanation": F.when(empty, "Empty formula").otherwise(said),
    }


def valid_formulas(raw: Column) -> Column:
    """Which formulas of an array are valid. One array a step: within a lambda, an expression is worked out anew wherever it stands."""
    plain = F.transform(raw, lambda f: F.struct((t.trim(f) == "").alias("empty"), normalized_formula(f).alias("c")))
    judged = F.transform(plain, lambda x: F.struct(
        x["empty"].alias("empty"), formula_syntax(x["c"]).alias("syntax"), formula_semantics(x["c"]).alias("semantics"), formula_consistency(x["c"]).alias("consistency"), complexity(x["c"]).alias("size"),
    ))
    return F.transform(judged, lambda x: ~x["empty"] & x["syntax"] & x["semantics"] & x["consistency"] & (_confidence(x["syntax"], x["semantics"], x["consistency"], x["size"]) >= 0.6))


def is_technical(c: Column) -> Column:
    from corpusloom.functions.assessment import TECHNICAL

    return t.has_any(F.lower(c), TECHNICAL)


def technical_accuracy(c: Column) -> Column:
    """Share of a text's code blocks and formulas that are valid; 1 where there are none."""
    lowered = F.transform(code_blocks(c), lambda b: F.struct(b["language"].alias("language"), b["code"].alias("code"), F.lower(b["code"]).alias("low")))
    code = F.transform(lowered, lambda b: code_danger(b["code"], b["language"], b["low"]).isNull() & b["language"].isin(*SYNTAX) & code_syntax(b["code"], b["language"]))
    math = valid_formulas(formulas(c))
    whole = F.array(F.concat(code, math))  # in an array of its own, so that a lambda reads it more than once
    return F.get(F.transform(whole, lambda x: F.when(F.size(x) > 0, F.size(F.filter(x, lambda ok: ok)) / F.size(x)).otherwise(1.0)), 0)
