"""Row-local lexing helpers: files in blocks, and the second level inside
f-strings.

Blocks.  A file is cut into blocks of whole lines of about ``BLOCK`` characters.
What a block's first character is in (code, a triple-quoted string, a block
comment, a template) depends on all text before it, so each block is a function
from entry state to exit state, and a fold over the file's blocks composes
these functions.  Blocks that begin inside a construct are joined to the one
before; each of the resulting blocks begins in plain code, can be tokenized
alone, and gives the same tokens as the whole file would.  So no array holds
more tokens than a block has, unless one token is longer than that.

f-strings.  Their replacement fields are code.  A fold over the pieces of the
string keeps a stack of modes: text of a string (``T`` and its quote), plain
string (``P`` and its quote), expression (``E``), brackets in it (``B``) and
format specification (``S``); fields nest to any depth.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters of a block, at least; a smaller file is one block.
BLOCK = 1 << 16

_STATES = "array<string>"


def _fold(items: Column, zero: Column, step) -> Column:
    return F.aggregate(items, zero, step)


def raw_blocks(content: Column, size: int) -> Column:
    """Blocks of whole lines; no cut behind a backslash, which may continue a string."""
    pattern = r"(?s).{1,%d}(?:(?<=[^\\]\n)|(?:.*?[^\\]\n)|.*+)" % size
    return F.regexp_extract_all(content, F.lit(pattern), 0)


_TRIPLE = {'"""': r'[^"\\]*+(?:(?:\\.|"(?!""))[^"\\]*+)*+"""', "'''": r"[^'\\]*+(?:(?:\\.|'(?!''))[^'\\]*+)*+'''"}
# what a triple quote, another string, a comment or plain text takes of a block of Python
_PY_COARSE = (r"(?s)(?:\"\"\"" + _TRIPLE['"""'] + r"|'''" + _TRIPLE["'''"] + r"|\"\"\".*|'''.*"
              r"|\"[^\"\\\n]*+(?:\\.[^\"\\\n]*+)*+\"|'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'|#[^\n]*+|[^\"'#]++|.)")


def _py_exit(state: Column, block: Column) -> Column:
    """The triple quote that is open at the block's end, or ''."""
    opened = lambda q: block.rlike(rf"(?s)\A{_TRIPLE[q]}")
    closed = F.when(state == '"""', opened('"""')).when(state == "'''", opened("'''")).otherwise(F.lit(True))
    rest = (F.when(state == '"""', F.regexp_replace(block, rf"(?s)\A{_TRIPLE['"""']}", ""))
            .when(state == "'''", F.regexp_replace(block, rf"(?s)\A{_TRIPLE["'''"]}", "")).otherwise(block))
    last = F.element_at(F.regexp_extract_all(rest, F.lit(_PY_COARSE), 0), -1)
    whole = last.rlike(rf"(?s)\A(?:\"\"\"{_TRIPLE['"""']}|'''{_TRIPLE["'''"]})\z")
    is_open = last.rlike(r"\A(?:\"\"\"|''')") & ~whole
    return F.when(~closed, state).when(rest == "", F.lit("")).when(is_open, F.substring(last, 1, 3)).otherwise(F.lit(""))


_JS_COARSE = r"(?s)\\.|//|/\*|\*/|\$\{|[\"'`{}/\[\]\n]|[^\"'`{}/\[\]\n\\$*]++|."


def _js_exit(state: Column, block: Column) -> Column:
    """The stack of modes at the block's end, one character each: ``T`` template text,
    ``E`` expression in it, ``B`` braces in that, ``C`` comment.  Strings (quotes), line
    comments (``L``) and regex literals (``R``, ``K`` their classes) end with their line."""
    pieces = F.regexp_extract_all(block, F.lit(_JS_COARSE), 0)
    before_regex = r"(?:[=(,:\[!&|?{;+\-*%<>~^\n]|return)[ \t]*\z"

    def step(acc, p):
        stack, prev = acc["stack"], acc["prev"]
        top = F.right(stack, F.lit(1))
        pop = F.left(stack, F.length(stack) - 1)
        push = lambda c: F.concat(stack, F.lit(c))
        code = top.isin("", "E", "B")
        now = (F.when(code, F.when(p.isin('"', "'"), F.concat(stack, p)).when(p == "`", push("T")).when(p == "//", push("L")).when(p == "/*", push("C"))
                      .when((p == "/") & prev.rlike(before_regex), push("R"))
                      .when((p.isin("{", "${")) & (top != ""), push("B")).when((p == "}") & (top != ""), pop).otherwise(stack))
               .when(top == "T", F.when(p == "`", pop).when(p == "${", push("E")).otherwise(stack))
               .when(top == "C", F.when(p == "*/", pop).otherwise(stack))
               .when(top == "R", F.when(p.isin("/", "//", "/*", "\n"), pop).when(p == "[", push("K")).otherwise(stack))
               .when(top == "K", F.when(p == "]", pop).when(p == "\n", F.left(stack, F.length(stack) - 2)).otherwise(stack))
               .when(top == "L", F.when(p == "\n", pop).otherwise(stack))
               .otherwise(F.when((p == top) | (p == "\n"), pop).otherwise(stack)))
        return F.struct(now.alias("stack"), F.when(code & p.rlike(r"\A[ \t]+\z"), prev).when(code, p).otherwise(F.lit("x")).alias("prev"))

    end = _fold(pieces, F.struct(state.alias("stack"), F.lit("\n").alias("prev")), step)["stack"]
    return F.regexp_replace(end, r"[\"'LRK]", "")


def code_blocks(content: Column, lang: str, size: int = BLOCK) -> Column:
    """The file's text in order, each element beginning outside strings, comments and templates."""
    if lang != "python":
        return F.array(content)  # planning the JavaScript fold costs tens of seconds a query: one block so far
    leave = _py_exit
    raw = raw_blocks(content, size)

    def joined(blocks: Column) -> Column:
        entry = _fold(blocks, F.array(F.lit("")), lambda acc, b: F.concat(acc, F.array(leave(F.element_at(acc, -1), b))))
        starts = F.filter(F.sequence(F.lit(0), F.size(blocks) - 1), lambda i: F.get(entry, i) == "")
        ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(blocks)))
        return F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda x: F.array_join(F.slice(blocks, x["a"] + 1, x["b"] - x["a"]), ""))

    # a one-element array binds the blocks to a variable, so that they are cut once
    many = F.flatten(F.transform(F.array(raw), joined))
    return F.when(F.length(content) <= size, F.array(content)).otherwise(many)


_PIECES = r"(?s)\"\"\"|'''|\\N\{[^{}]*\}|\\[^{}]|[\p{L}\p{N}_]+|."
_F_PREFIX = r"(?i)\A(?:f|fr|rf)['\"]"
_DECISIONS = "array<struct<line:int,kind:string>>"


def fstring_decisions(tok: Column) -> Column:
    """Decisions in the replacement fields of a string token: (line, counted from the
    token's first; kind).  Null for tokens without any."""
    none = F.array().cast(_DECISIONS)
    pieces = F.transform(F.regexp_extract_all(tok, F.lit(_PIECES), 0), lambda x: x)

    def step(acc, p):
        stack, prev, skip = acc["stack"], acc["prev"], acc["skip"]
        top = F.element_at(stack, -1)
        pop = F.slice(stack, 1, F.size(stack) - 1)
        push = lambda c: F.concat(stack, F.array(c))
        swap = lambda c: F.concat(pop, F.array(F.lit(c)))
        quote = p.isin('"', "'", '"""', "'''")
        code, text = top.isin("E", "B"), top.startswith("T")
        into = F.when(prev.rlike(r"(?i)\A(?:f|fr|rf)\z"), F.lit("T")).otherwise(F.lit("P"))
        # {{ in text: the first brace opens a field that the second, at once, takes back
        now = (F.when(text & (p == "{"), push(F.lit("E"))).when(text & (p == F.substring(top, F.lit(2), F.lit(3))), pop).when(text, stack)
               .when(top.startswith("P"), F.when(p == F.substring(top, F.lit(2), F.lit(3)), pop).otherwise(stack))
               .when(code & (top == "E") & (p == "{") & (prev == "{") & skip, pop)
               .when(code & quote, push(F.concat(into, p)))
               .when(code & p.isin("(", "[", "{"), push(F.lit("B")))
               .when((top == "B") & p.isin(")", "]", "}"), F.when(F.size(stack) > 1, pop).otherwise(stack))
               .when((top == "E") & (p == "}"), pop).when((top == "E") & (p == ":"), swap("S"))
               .when((top == "S") & (p == "{"), push(F.lit("E"))).when((top == "S") & (p == "}"), pop)
               .otherwise(stack))
        kind = F.when(code & p.isin("and", "or"), F.lit("boolean_operator")).when(code & (p == "else"), F.lit("conditional_expression"))
        line = acc["line"] + F.length(p) - F.length(F.replace(p, F.lit("\n"), F.lit("")))
        return F.struct(now.alias("stack"), p.alias("prev"), (text & (p == "{")).alias("skip"), line.cast("int").alias("line"),
                        F.when(kind.isNotNull(), F.concat(acc["out"], F.array(F.struct(acc["line"].alias("line"), kind.alias("kind"))))).otherwise(acc["out"]).alias("out"))

    zero = F.struct(F.array(F.lit("B")).alias("stack"), F.lit("").alias("prev"), F.lit(False).alias("skip"), F.lit(0).alias("line"), none.alias("out"))
    return F.when(tok.contains("{") & (F.length(tok) > 3) & tok.rlike(_F_PREFIX) & tok.rlike(r"\b(?:and|or|else)\b"), _fold(pieces, zero, step)["out"])


def _field(depth: int, newline: str) -> str:
    """A replacement field: braces that pair up to ``depth`` deep, anything else inside."""
    inner = rf"[^{{}}\\{newline}]++|\\."
    return rf"\{{(?:{inner}" + (f"|{_field(depth - 1, newline)}" if depth else "") + r")*+\}"


def fstring_pattern(depth: int = 3) -> str:
    """f-strings whose fields may hold the string's own quotes; others fit the plain patterns."""
    text = lambda stop, newline, own: (rf"(?:[^{stop}\\{{}}{newline}]++|\\N\{{[^{{}}\n]*+\}}|\\[^{{}}]{own}|\{{\{{|\}}\}}|{_field(depth, newline)})*+")
    return (r"(?:[fF][rR]?|[rR][fF])(?:"
            r'"""' + text('"', "", r'|"(?!"")') + r'"""' + r"|'''" + text("'", "", r"|'(?!'')") + r"'''"
            r'|"(?!"")' + text('"', r"\n", "") + r'"' + r"|'(?!'')" + text("'", r"\n", "") + r"')")


def template_pattern(depth: int = 4, braces: int = 2) -> str:
    """JavaScript templates: ``${…}`` holds text, pairs of braces and templates to ``depth``."""
    def field(d: int, b: int) -> str:
        inside = r"[^`{}\\]++|\\."
        if d:
            inside += "|" + template(d - 1)
        if b:
            inside += r"|\{(?:" + field(d, b - 1) + r")*+\}"
        return inside

    def template(d: int) -> str:
        return r"`(?:[^`\\$]++|\\.|\$(?!\{)|\$\{(?:" + field(d, braces) + r")*+\})*+`"

    return template(depth)
