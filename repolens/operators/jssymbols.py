"""JavaScript outline: function declarations, methods, class declarations.

Brace method on the token stream (no parser):

* brackets are numbered by *level* (the depth outside them); in a window
  over ``(repo, path, level)`` ordered by position, an opening bracket is
  followed by its closing one, so ``lead`` pairs them in linear time;
* ``function NAME (…) {…}`` at statement position is a declaration;
* ``NAME (…) {…}`` with a non-keyword NAME is a method (class body or
  object literal), with leading ``static/async/get/set/*`` inside the span;
* ``class NAME … {…}`` at statement position is a class declaration.

Not matched, like the grammar query they mirror: arrow functions, function
expressions, generators (``function*``), private ``#m`` and computed or
string-named methods, class expressions and classes without a name (their
methods stand alone).  A keyword names a method directly in a class body, and
in an object literal behind its brace or a comma.

Brackets have kinds: a brace opens a class body, an object literal (behind an
operator, an opening bracket, a comma, ``return`` or the like, or the colon of
a property) or else a block.  The bracket that is open at each level is the
stack of kinds; the window by level holds one entry of it.
The enclosing class (declarations only) is found in the same pass with
the level method: a class body is tagged in the bracket-level window, each
candidate is copied to every shallower class-body level as a lookup row,
and in a window over ``(repo, path, level)`` the last bracket before the
lookup tells whether that level's open bracket is a class body.  One
linear pipeline over the file's tokens: no self-join, no pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repolens.functions.text import classify_language
from repolens.operators import tokens as T

_FILE = ["repo", "path"]

# Words that are not method names, tokens after which a
# `function` / `class` keyword is an expression, and method modifiers.
JS_KEYWORDS = ["if", "for", "while", "switch", "catch", "function", "return", "with",
               "typeof", "new", "delete", "void", "await", "yield", "super", "import"]
EXPRESSION_PREV = ["=", "(", ",", ":", "[", "!", "&", "|", "?", "+", "-", "*", "/", "%",
                   "<", ">", "~", "^", "return", "typeof", "void", "delete", "new",
                   "await", "yield", "in", "of", "case", "=>", "."]
METHOD_MODIFIERS = ["static", "async", "get", "set", "*"]
# Tokens before a brace that opens an object literal.
OBJECT_PREV = ["=", "(", ",", "[", "!", "&", "|", "?", "+", "-", "*", "/", "%", "<", ">", "~", "^",
               "return", "typeof", "void", "delete", "new", "await", "yield", "in", "of", "case"]
# Single words and signs that decide, and all groups: a token is in any of them, one bit each.
_FUNCTION, _ASYNC, _STAR, _GREATER, _EQUALS, _COLON, _DEFAULT = ["function"], ["async"], ["*"], [">"], ["="], [":"], ["default"]
_FIRST, _NO_METHOD_PREV = ["{", ","], ["function", ".", "extends", "#", "new", "class"]
_GROUPS = [JS_KEYWORDS, EXPRESSION_PREV, METHOD_MODIFIERS, OBJECT_PREV, _FUNCTION, _ASYNC, _STAR, _GREATER, _EQUALS, _COLON, _DEFAULT, _FIRST, _NO_METHOD_PREV]
_NO_TOKEN = 1 << len(_GROUPS)
_WORD = r"^[\p{L}_$][\p{L}\p{N}_$]*$"
_OPEN, _CLOSE = ["(", "[", "{"], [")", "]", "}"]


def _classes(tok: Column) -> Column:
    """The groups a token is in, as bits."""
    of = {}
    for bit, group in enumerate(_GROUPS):
        for word in group:
            of[word] = of.get(word, 0) | 1 << bit
    by_bits = {}
    for word, bits in of.items():
        by_bits.setdefault(bits, []).append(word)
    out = F
    for bits, words in by_bits.items():
        out = out.when(tok.isin(*words), bits)
    return F.when(tok.isin(*of), out.otherwise(0)).otherwise(0)


def js_symbols(files: DataFrame, partitioned: bool = False) -> DataFrame:
    js = files.where(classify_language(F.col("path")) == "javascript")
    toks = T.tokenize(js, "javascript", partitioned=partitioned).where("sig").withColumn("cls", _classes(F.col("tok")))
    w = Window.partitionBy(*_FILE).orderBy("pos")
    tok = F.col("tok")
    sig = toks.select(
        *_FILE, "pos", "tok", "off", "line", "dpt",
        F.lag("tok", 1).over(w).alias("name"), *[F.lag("cls", k, _NO_TOKEN).over(w).alias(f"p{k}_cls") for k in (1, 2, 3, 4)],
        *[F.lag(c, k).over(w).alias(f"p{k}_{c}") for k in (1, 2, 3) for c in ("line", "off")],
        F.lead("tok", 1).over(w).alias("n1"))

    flag = lambda c: F.coalesce(c, F.lit(False))
    # the groups of the four tokens before, in one number
    width = len(_GROUPS) + 1
    sig = sig.withColumn("prev", F.expr(" | ".join(f"shiftleft(bigint(p{k}_cls), {width * (k - 1)})" for k in (1, 2, 3, 4))))
    before = lambda k, group: F.col("prev").bitwiseAND(F.lit(1 << (_GROUPS.index(group) + width * (k - 1)))) != 0
    is_class_kw = (tok == "class") & F.col("n1").rlike(_WORD) & (F.col("n1") != "extends") & ~before(1, EXPRESSION_PREV)
    paren = tok == "("
    # what the tokens before a bracket allow; rows go on with these few columns
    named = flag(paren & F.col("name").rlike(_WORD))
    maybe_func = named & before(2, _FUNCTION) & ((before(3, _ASYNC) & ~before(4, EXPRESSION_PREV)) | (~before(3, _ASYNC) & ~before(3, EXPRESSION_PREV)))
    maybe_method = named & ~(before(2, _STAR) & before(3, _FUNCTION)) & ~before(2, _NO_METHOD_PREV)
    first_of_kind = before(2, _FIRST) | (before(2, METHOD_MODIFIERS) & (before(3, _FIRST) | (before(3, METHOD_MODIFIERS) & before(4, _FIRST))))
    arrow = before(1, _GREATER) & (before(2, _EQUALS) | (F.col("p2_cls") == _NO_TOKEN))
    of_property = before(1, _COLON) & before(3, _FIRST) & ~before(2, _DEFAULT)
    is_object = (tok == "{") & ((before(1, OBJECT_PREV) & ~arrow) | of_property)
    # how many tokens before the bracket the symbol starts (0: at the token itself)
    back = (F.when(tok == "class", 0).when(before(2, _FUNCTION), F.when(before(3, _ASYNC), 3).otherwise(2))
            .when(before(2, METHOD_MODIFIERS), F.when(before(3, METHOD_MODIFIERS), 3).otherwise(2)).otherwise(1))
    start = lambda f: F.when(back == 0, F.col(f)).when(back == 1, F.col(f"p1_{f}")).when(back == 2, F.col(f"p2_{f}")).otherwise(F.col(f"p3_{f}"))
    stream = sig.where(tok.isin(*_OPEN, *_CLOSE) | is_class_kw).select(
        *_FILE, "pos", "tok", "off", "line", "dpt", "n1",
        F.when(tok.isin(*_CLOSE), F.col("dpt") - 1).otherwise(F.col("dpt")).alias("lvl"),
        F.when(paren, F.col("name")).when(tok == "class", F.col("n1")).alias("name"),
        F.when(paren | (tok == "class"), start("line")).alias("st_line"), F.when(paren | (tok == "class"), start("off")).alias("st_off"),
        maybe_func.alias("maybe_func"), maybe_method.alias("maybe_method"),
        (paren & before(1, JS_KEYWORDS)).alias("keyword"), (paren & first_of_kind).alias("first_of_kind"), is_object.alias("is_object"))

    wl = Window.partitionBy(*_FILE, "lvl").orderBy("pos")
    ahead = {1: ("tok", "off", "n1"), 2: ("tok", "line", "off"), 3: ("tok", "line", "off"), 4: ("line", "off")}
    stream = stream.select("*", *[F.lead(c, k).over(wl).alias(f"l{k}_{c}") for k, cs in ahead.items() for c in cs],
                           *[F.lag("tok", k).over(wl).alias(f"g{k}_tok") for k in (1, 2, 3)], *[F.lag("n1", k).over(wl).alias(f"g{k}_n1") for k in (1, 3)])
    l = lambda k, f: F.col(f"l{k}_{f}")
    g = lambda k, f: F.col(f"g{k}_{f}")
    body_ok = flag((l(1, "tok") == ")") & (l(1, "n1") == "{") & (l(2, "tok") == "{") & (l(3, "tok") == "}"))
    is_func, is_method = F.col("maybe_func") & body_ok, F.col("maybe_method") & body_ok
    # a keyword's name is a method's only directly in a class body or an object literal, which is known below
    in_class_only = is_method & F.col("keyword")
    may_be_property = in_class_only & F.col("first_of_kind")
    is_def = is_func | is_method
    body_at1 = flag(l(1, "tok") == "{")
    body_at3 = flag((l(1, "tok") == "(") & (l(3, "tok") == "{"))
    is_class = (tok == "class") & (body_at1 | body_at3)
    # class bodies, tagged from the bracket-level predecessors of '{'
    body_of = (F.when((tok == "{") & (g(1, "tok") == "class"), g(1, "n1"))
               .when((tok == "{") & (g(1, "tok") == ")") & (g(2, "tok") == "(") & (g(3, "tok") == "class"), g(3, "n1")))
    stream = stream.select(
        *_FILE, "pos", "tok", "dpt", "lvl", "is_object", body_of.alias("body_of"), may_be_property.alias("may_be_property"),
        is_def.alias("is_def"), (is_def | is_class).alias("is_symbol"),
        F.when(is_def | is_class, F.struct(
            F.when(is_def, F.lit("def")).otherwise(F.lit("class")).alias("kind"), "name", "st_line", "st_off",
            F.when(in_class_only, F.col("dpt") - 1).alias("body_level"),
            F.when(is_def, F.col("off")).alias("open_off"),
            F.when(is_def, l(1, "off")).alias("close_off"),
            F.when(is_def, l(3, "line")).when(body_at1, l(2, "line")).otherwise(l(4, "line")).alias("end_line"),
            (F.when(is_def, l(3, "off")).when(body_at1, l(2, "off")).otherwise(l(4, "off")) + 1).alias("end_off"))).alias("info"))
    whole = Window.partitionBy(*_FILE)
    stream = stream.select("*", F.collect_set(F.when(F.col("body_of").isNotNull(), F.col("lvl"))).over(whole).alias("class_levels"),
                           F.collect_set(F.when(F.col("may_be_property"), F.col("dpt") - 1)).over(whole).alias("property_levels"))

    is_def = F.col("is_def")
    levels = F.concat(
        F.when((F.array_contains("class_levels", F.col("lvl")) | F.array_contains("property_levels", F.col("lvl"))) & tok.isin(*_OPEN, *_CLOSE), F.array(F.col("lvl")))
        .otherwise(F.array().cast("array<int>")),
        F.when(is_def, F.array_union(F.filter("class_levels", lambda v: v < F.col("dpt")), F.when(F.col("may_be_property"), F.array(F.col("dpt") - 1)).otherwise(F.array().cast("array<int>"))))
        .otherwise(F.array().cast("array<int>")),
        F.when(F.col("is_symbol"), F.array(F.lit(-1))).otherwise(F.array().cast("array<int>")))
    rows = stream.select(*_FILE, "pos", "tok", "lvl", "body_of", "is_object", "may_be_property", "info",
                         F.explode(levels).alias("v"))
    # own row per candidate (v = -1), bracket rows at their level, lookups below
    rows = rows.withColumn("role", F.when(F.col("v") == -1, F.lit("self"))
                           .when((F.col("v") == F.col("lvl")) & F.col("tok").isin(*_OPEN, *_CLOSE), F.lit("br"))
                           .otherwise(F.lit("lk")))
    wv = Window.partitionBy(*_FILE, "v").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    last_br = F.last(F.when(F.col("role") == "br", F.struct(
        ((F.col("tok") == "{") & F.col("body_of").isNotNull()).alias("open_class"), F.col("body_of").alias("name"), "is_object")),
        ignorenulls=True).over(wv)
    rows = rows.select("*", last_br.alias("last_br"))
    enclosing = F.when((F.col("role") == "lk") & F.col("last_br.open_class"), F.col("last_br.name"))
    in_object = F.coalesce((F.col("role") == "lk") & F.col("may_be_property") & (F.col("v") == F.col("lvl") - 1) & F.col("last_br.is_object"), F.lit(False))
    grouped = (rows.where((F.col("role") == "self") | enclosing.isNotNull() | in_object)
               .groupBy(*_FILE, "pos")
               .agg(F.max(in_object).alias("in_object"),
                    F.first(F.when(F.col("role") == "self", F.col("info")), ignorenulls=True).alias("i"),
                    F.max(F.when(enclosing.isNotNull(), F.col("v"))).alias("class_level"),
                    F.max_by(enclosing, F.when(enclosing.isNotNull(), F.col("v"))).alias("class_name")))
    is_symbol = F.col("i").isNotNull() & (F.col("i.body_level").isNull() | (F.col("i.body_level") == F.coalesce("class_level", F.lit(-2))) | F.col("in_object"))
    return grouped.where(is_symbol).select(
        *_FILE, F.lit("javascript").alias("lang"), F.col("i.kind").alias("kind"), F.col("i.name").alias("name"),
        F.when(F.col("i.kind") == "def", F.col("class_name")).alias("class_name"),
        F.col("i.st_line").cast("int").alias("start_line"), F.col("i.end_line").cast("int").alias("end_line"),
        F.col("pos").alias("start_pos"), F.col("i.st_off").alias("start_off"), F.col("i.end_off").alias("end_off"),
        F.col("i.open_off").alias("open_off"), F.col("i.close_off").alias("close_off"),
        F.lit(None).cast("long").alias("arrow_off"), F.lit(None).cast("long").alias("colon_off"),
        F.lit(None).cast("long").alias("doc_off"), F.lit(None).cast("long").alias("doc_end_off"),
        F.lit(None).cast("int").alias("complexity"))

