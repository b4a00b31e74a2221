"""Tokenize source files and group tokens into logical lines.

Everything here runs on one hash partitioning of ``files`` by
``(repo, path)``: the only shuffle is that of the file text itself (compact),
and every later window and aggregate is keyed by ``(repo, path, ...)`` so
Spark plans no further exchange.  Tokens are never shuffled.

Token rules (Python; JavaScript differs only in strings and comments):
strings (with prefixes, triple quotes), comments, backslash continuations,
newlines, blanks, words, then any single character.  Per token we derive

* ``off``   character offset in the file (0-based)
* ``line``  1-based line of its first character
* ``dpt``   bracket depth before the token
* ``ll``    logical line: count of depth-0 newlines before the token
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repolens.operators import lexing as X

# Java regex, alternatives tried in order.  Loops are unrolled and
# possessive so long strings do not recurse in the regex engine.
_PY_STRING = (
    r"(?:[rRbBuUfF]{1,2})?(?:"
    r'"""[^"\\]*+(?:(?:\\.|"(?!""))[^"\\]*+)*+"""'
    r"|'''[^'\\]*+(?:(?:\\.|'(?!''))[^'\\]*+)*+'''"
    r'|"[^"\\\n]*+(?:\\.[^"\\\n]*+)*+"'
    r"|'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+')"
)
# Leading blanks are attached to the token that follows them (possessive,
# so a token never starts with a blank it could have taken): fewer rows,
# and the blanks before a line's first token are its indentation.
_BLANKS = r"[ \t\f]*+"
PY_TOKEN_RE = (
    r"(?s)" + _BLANKS + r"(?:" + X.fstring_pattern() + r"|" + _PY_STRING
    + r"|#[^\n]*"
    + r"|\\\r?\n"
    + r"|\r?\n"
    + r"|->"
    + r"|[\p{L}\p{N}_]+"
    + r"|.)"
)

_JS_STRING = (
    r'"[^"\\\n]*+(?:\\.[^"\\\n]*+)*+"'
    r"|'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'"
    # templates: what doesn't pair in ${…} goes up to the next backtick
    r"|" + X.template_pattern() + r"|`[^`\\]*+(?:\\.[^`\\]*+)*+`"
)
# A slash starts a regex literal after an operator, an opening bracket or `return`.
_JS_REGEX = (
    r"(?<=(?:\A|[=(,:\[!&|?{;+\-*%<>~^\n]|return)[ \t]{0,16})/(?![/*])"
    r"(?:[^/\\\[\n]|\\.|\[(?:[^\]\\\n]|\\.)*+\])++/[a-z]*+"
)
JS_TOKEN_RE = (
    r"(?s)" + _BLANKS + r"(?:" + _JS_STRING
    + r"|//[^\n]*"
    + r"|/\*.*?\*/"
    + r"|" + _JS_REGEX
    + r"|\r?\n"
    + r"|[\p{L}\p{N}_$]+"
    + r"|.)"
)

_FILE = ["repo", "path"]
STRING_START = r"^(?:[rRbBuUfF]{1,2})?['\"]"


def partition_files(files: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Hash-partition files by (repo, path) once; all per-file windows reuse it.

    The partition count is explicit (default: the session's
    ``spark.sql.shuffle.partitions``) because the file text is small in
    bytes but expands ~50x into tokens: adaptive coalescing, which sizes
    partitions by shuffled bytes, would otherwise squeeze the whole
    token pipeline into a handful of tasks.  A files table written
    bucketed by (repo, path) makes this shuffle free.
    """
    if not num_partitions:
        num_partitions = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(num_partitions, *_FILE)


def tokenize(files: DataFrame, lang: str = "python", partitioned: bool = False, block: int = X.BLOCK) -> DataFrame:
    """files(repo, path, content) -> tokens.

    Columns: repo, path, pos, tok, lead, ws, off, line, nl, dpt, nlc, sig.
    ``tok`` is the token without its leading blanks ``ws`` (``lead`` chars);
    ``off`` is the offset of ``tok``; ``nlc`` counts newline tokens before
    it; ``sig`` marks significant tokens (not newline, comment or
    continuation).

    Brackets that don't pair stay local: a stray closing one leaves the depth
    at 0, and in Python ``def`` and ``class`` at the start of a line (no
    expression holds them) start anew at depth 0.  ``bad`` marks both.

    A file of more than ``block`` characters is tokenized in blocks (see
    ``lexing``), so its tokens are never one array; ``pos`` is the token's number
    in its block, with the block's number in the upper 32 bits.
    """
    pattern = PY_TOKEN_RE if lang == "python" else JS_TOKEN_RE
    src = files if partitioned else partition_files(files)
    blocks = src.select(*_FILE, F.posexplode(X.code_blocks(F.col("content"), lang, block)).alias("block", "text"))
    raw = blocks.select(*_FILE, "block", F.posexplode(F.regexp_extract_all("text", F.lit(pattern), 0)).alias("nth", "raw"))

    rawc = F.col("raw")
    tok = F.ltrim(rawc, F.lit(" \t\f"))
    lead = (F.length(rawc) - F.length(tok)).cast("int")
    raw = raw.select(*_FILE, (F.shiftleft(F.col("block").cast("long"), 32) + F.col("nth")).alias("pos"), tok.alias("tok"), lead.alias("lead"), F.length(rawc).alias("len_raw"),
                     F.substring(rawc, 1, lead).alias("ws"))

    tok = F.col("tok")
    c0 = F.substring(tok, 1, 1)
    # Plain string tests (no regex per token): token classes follow from
    # the first characters because the tokenizer emits whole runs.
    nl = (F.length(tok) - F.length(F.replace(tok, F.lit("\n"), F.lit("")))).cast("int")
    delta = (F.when(tok.isin("(", "[", "{"), 1).when(tok.isin(")", "]", "}"), -1).otherwise(0))
    is_newline = tok.isin("\n", "\r\n")
    is_comment = (c0 == "#") if lang == "python" else (tok.startswith("//") | tok.startswith("/*"))
    is_cont = (c0 == "\\") & (F.length(tok) > 1)
    sig = ~(is_newline | is_comment | is_cont | (tok == ""))

    w = Window.partitionBy(*_FILE).orderBy("pos")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    previous = F.lag("tok", 1, "\n").over(w)
    at_margin = (tok.isin("def", "class", "async") & (F.col("lead") == 0) & previous.isin("\n", "\r\n")
                 if lang == "python" else F.lit(False))
    summed = raw.select(
        *_FILE, "pos", "tok", "lead", "ws", nl.alias("nl"), sig.alias("sig"), delta.alias("delta"), at_margin.alias("at_margin"),
        (F.coalesce(F.sum("len_raw").over(before), F.lit(0)) + F.col("lead")).cast("long").alias("off"),
        (F.coalesce(F.sum(nl).over(before), F.lit(0)) + 1).cast("int").alias("line"),
        F.coalesce(F.sum(delta).over(before), F.lit(0)).cast("int").alias("open"),
        F.coalesce(F.sum(F.when(is_newline, 1).otherwise(0)).over(before), F.lit(0)).cast("int").alias("nlc"))
    # Depth counts from the last new start, before the first one from the lowest
    # point so far; what is still open at a new start is left behind.
    floor = F.least(F.lit(0), F.min("open").over(upto))
    start = F.when(F.col("at_margin"), F.col("open"))
    summed = summed.select("*", F.coalesce(F.last(start, ignorenulls=True).over(upto), floor).alias("base"),
                           F.coalesce(F.last(start, ignorenulls=True).over(before), floor).alias("base_before"))
    dpt = F.greatest(F.lit(0), F.col("open") - F.col("base")).cast("int")
    bad = ((F.col("delta") < 0) & (F.col("open") <= F.col("base"))) | (F.col("at_margin") & (F.col("open") > F.col("base_before")))
    return summed.select(*_FILE, "pos", "tok", "lead", "ws", "nl", "sig", "off", "line", dpt.alias("dpt"), "nlc", bad.alias("bad"))


def bracket_problems(files: DataFrame, lang: str = "python") -> DataFrame:
    """Where brackets don't pair: (repo, path, line, problem)."""
    return tokenize(files, lang).where("bad").select(
        *_FILE, F.col("line").cast("bigint").alias("line"), F.lit("unbalanced bracket").alias("problem"))


def _indent_width(ws: Column) -> Column:
    """Column of the first character after leading blanks (tabs to 8)."""
    chars = F.split(ws, "")
    return F.aggregate(chars, F.lit(0),
                       lambda acc, c: F.when(c == "\t", acc - acc % 8 + 8)
                       .when(c == "\f", F.lit(0)).otherwise(acc + 1)).cast("int")


def logical_lines(tokens: DataFrame, decision_lines: bool = False) -> DataFrame:
    """Significant tokens grouped into logical lines (one row per line).

    A significant token opens a new logical line when it is at depth 0 and
    a newline token lies between it and the previous significant token
    (those newlines are then at depth 0 too: only non-significant tokens
    sit in between).  Works on significant tokens only.  Decisions inside
    f-strings count for the string's line.

    Columns: repo, path, ll, first_pos, first_off, t1, t2, t3, n_sig,
    indent, start_line, last_line, end_off, alone, open_off, close_off, colon_off,
    arrow_off, n_andor, n_else (+ andor_lines, else_lines on request).
    """
    w = Window.partitionBy(*_FILE).orderBy("pos")
    sig = tokens.where("sig")
    prev_nlc, next1_nlc, next2_nlc = F.lag("nlc", 1).over(w), F.lead("nlc", 1).over(w), F.lead("nlc", 2).over(w)
    sig = sig.select(
        "*",
        (prev_nlc.isNull() | ((F.col("dpt") == 0) & (F.col("nlc") > prev_nlc))).alias("is_first"),
        F.lag(F.struct("tok", "dpt", "off"), 1).over(w).alias("behind"),
        F.lead("tok", 1).over(w).alias("t_next1"), F.lead("tok", 2).over(w).alias("t_next2"),
        # the next tokens belong to this line unless they open a new one
        (~((F.lead("dpt", 1).over(w) == 0) & (next1_nlc > F.col("nlc")))).alias("same1"),
        (~(((F.lead("dpt", 1).over(w) == 0) & (next1_nlc > F.col("nlc")))
           | ((F.lead("dpt", 2).over(w) == 0) & (next2_nlc > next1_nlc)))).alias("same2"))
    sig = sig.withColumn("inner", X.fstring_decisions(F.col("tok")))
    sig = sig.withColumn("ll", F.sum(F.when(F.col("is_first"), 1).otherwise(0)).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int"))
    tok, dpt, off = F.col("tok"), F.col("dpt"), F.col("off")
    is_first = F.col("is_first")
    first_info = F.when(is_first, F.struct(
        F.col("pos"), off.alias("off"), tok.alias("t1"),
        F.when(F.col("same1"), F.col("t_next1")).alias("t2"),
        F.when(F.col("same2"), F.col("t_next2")).alias("t3"),
        F.col("line"), F.col("ws")))
    # few tokens are f-strings with decisions: the arrays are only looked at for those
    inner_count = lambda kind: F.when(F.col("inner").isNotNull(), F.size(F.filter("inner", lambda x: x["kind"] == kind))).otherwise(0)
    boolean, conditional = inner_count("boolean_operator"), inner_count("conditional_expression")
    # a string alone behind a colon outside brackets: the docstring of a definition on one line
    alone = ((F.col("behind.tok") == ":") & (F.col("behind.dpt") == 0) & tok.rlike(STRING_START)
             & (F.col("t_next1").isNull() | ~F.col("same1") | (F.col("t_next1") == ";")))
    # tokens are sorted once more by lines, with numbers only; a line's first token brings its text
    narrow = [*_FILE, "ll", first_info.alias("f"),
              F.when(alone, F.struct(F.col("behind.off").alias("colon"), off.alias("off"), (off + F.length(tok)).alias("end"))).alias("alone"),
              (F.col("line") + F.col("nl")).alias("last_line"), (off + F.length(tok)).alias("end_off"),
              F.when((tok == "(") & (dpt == 0), off).alias("open_off"), F.when((tok == ")") & (dpt == 1), off).alias("close_off"),
              F.when((tok == ":") & (dpt == 0), off).alias("colon_off"), F.when((tok == "->") & (dpt == 0), off).alias("arrow_off"),
              F.when(tok.isin("and", "or"), 1).otherwise(boolean).alias("n_andor"), F.when((tok == "else") & ~is_first, 1).otherwise(conditional).alias("n_else")]
    extra = []
    if decision_lines:
        narrow += [F.when(tok.isin("and", "or"), F.col("line")).alias("andor_line"), F.when((tok == "else") & ~is_first, F.col("line")).alias("else_line"), "line", "inner"]
        line = F.col("line")
        inner_lines = lambda kind: F.flatten(F.collect_list(F.transform(F.filter("inner", lambda x: x["kind"] == kind), lambda x: (x["line"] + line).cast("int"))))
        extra = [F.sort_array(F.concat(F.collect_list("andor_line"), inner_lines("boolean_operator"))).alias("andor_lines"),
                 F.sort_array(F.concat(F.collect_list("else_line"), inner_lines("conditional_expression"))).alias("else_lines")]
    agg = (sig.select(*narrow).groupBy(*_FILE, "ll").agg(*extra,
        F.min_by("alone", F.col("alone.off")).alias("alone"),
        F.first("f", ignorenulls=True).alias("f"),
        F.count(F.lit(1)).alias("n_sig"),
        F.max("last_line").alias("last_line"),
        F.max("end_off").alias("end_off"),
        F.min("open_off").alias("open_off"),
        F.min("close_off").alias("close_off"),
        F.min("colon_off").alias("colon_off"),
        F.min("arrow_off").alias("arrow_off"),
        F.sum("n_andor").alias("n_andor"),
        F.sum("n_else").alias("n_else"),
    ))
    return agg.select(
        *_FILE, "ll",
        F.col("f.pos").alias("first_pos"), F.col("f.off").alias("first_off"),
        F.col("f.t1").alias("t1"), F.col("f.t2").alias("t2"), F.col("f.t3").alias("t3"),
        "n_sig",
        # indentation: the blanks attached to the line's first token (tabs to 8)
        F.when(F.col("f.ws").rlike("[\t\f]"), _indent_width(F.col("f.ws")))
        .otherwise(F.length(F.col("f.ws"))).alias("indent"),
        F.col("f.line").alias("start_line"),
        "last_line", "end_off", "alone", "open_off", "close_off", "colon_off", "arrow_off",
        "n_andor", "n_else", *(["andor_lines", "else_lines"] if decision_lines else []))
