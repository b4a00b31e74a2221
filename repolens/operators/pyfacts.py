"""Per-file Python facts from logical lines: imports and decision points."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repolens.functions.text import suffix
from repolens.operators import tokens as T
from repolens.operators.symbols import DECISION_KEYWORDS

_FILE = ["repo", "path"]


def _python_files(files: DataFrame) -> DataFrame:
    return files.where(suffix(F.col("path")) == ".py")


def import_statements(files: DataFrame, include_future: bool = False) -> DataFrame:
    """Every import statement of every .py file, at any depth:
    (repo, path, line, stmt).  ``from __future__`` lines are a separate kind
    in the grammar and are left out unless asked for.

    A statement starts a logical line, or follows a ``;`` or a header's ``:``
    outside brackets; it ends before the next ``;``.  Its text is put together
    from its tokens, so the files' text is shuffled once."""
    toks = T.tokenize(_python_files(files), "python")
    w = Window.partitionBy(*_FILE).orderBy("pos")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = lambda c: F.last(F.when(F.col("sig"), F.col(c)), ignorenulls=True).over(before)
    toks = toks.select("*", last("tok").alias("prev_tok"), last("nlc").alias("prev_nlc"))
    tok, outside = F.col("tok"), F.col("dpt") == 0
    starts = F.col("sig") & (F.col("prev_tok").isNull() | (outside & (
        (F.col("nlc") > F.col("prev_nlc")) | (F.col("prev_tok") == ";")
        | ((F.col("prev_tok") == ":") & tok.isin("import", "from")))))
    toks = toks.withColumn("head", F.when(starts, F.struct("tok", "pos", "line")))
    toks = toks.withColumn("head", F.last("head", ignorenulls=True).over(upto)).where(F.col("head.tok").isin("import", "from"))
    of_stmt = F.sort_array(F.collect_list(F.struct("pos", "tok", "ws", "sig")))
    end = F.max(F.when(F.col("sig") & ~(outside & (tok == ";")), F.col("pos")))
    stmts = toks.groupBy(*_FILE, F.col("head.pos").alias("at"), F.col("head.line").alias("line")).agg(of_stmt.alias("parts"), end.alias("end"))
    inside = F.filter("parts", lambda x: x["pos"] <= F.col("end"))
    if not include_future:
        words = F.filter("parts", lambda x: x["sig"])
        stmts = stmts.where(~((F.get(words, 0)["tok"] == "from") & (F.get(words, 1)["tok"] == "__future__")))
    text = F.array_join(F.transform(inside, lambda x, i: F.when(i == 0, x["tok"]).otherwise(F.concat(x["ws"], x["tok"]))), "")
    return stmts.select(*_FILE, "line", text.alias("stmt"))


def imports(files: DataFrame) -> DataFrame:
    """(repo, path, import_count, imports): distinct statements, sorted; every
    .py file appears (count 0 when it imports nothing)."""
    stmts = import_statements(files)
    per_file = stmts.groupBy(*_FILE).agg(F.sort_array(F.collect_set("stmt")).alias("imports"))
    every = _python_files(files).select(*_FILE)
    out = every.join(per_file, _FILE, "left")
    arr = F.coalesce(F.col("imports"), F.array().cast("array<string>"))
    return out.select(*_FILE, F.size(arr).cast("bigint").alias("import_count"), arr.alias("imports"))


def distinct_imports(files: DataFrame) -> DataFrame:
    """(repo, stmt, files): each distinct statement of a repository and the number
    of its files that have it.  Pre-aggregated by (repo, stmt, path)."""
    return import_statements(files).groupBy("repo", "stmt").agg(F.count_distinct("path").alias("files"))


def decision_points(files: DataFrame) -> DataFrame:
    """One row per decision: (repo, path, line, kind) with the grammar's node
    kinds (if/for/while/except/with statement, case clause, boolean operator,
    conditional expression)."""
    py = _python_files(files)
    ll = T.logical_lines(T.tokenize(py, "python"), decision_lines=True)
    t1, t2 = F.col("t1"), F.col("t2")
    kw = (F.when(t1.isin(*DECISION_KEYWORDS), t1)
          .when((t1 == "async") & t2.isin("for", "with"), t2)
          .when((t1 == "case") & F.col("colon_off").isNotNull()
                & ~F.coalesce(t2, F.lit(":")).isin("=", ".", ",", ")", ":"), F.lit("case")))
    kind_name = F.when(kw == "case", F.lit("case_clause")).when(kw == "except", F.lit("except_clause")) \
        .otherwise(F.concat(kw, F.lit("_statement")))
    head = F.when(kw.isNotNull(), F.array(F.struct(F.col("start_line").alias("line"), kind_name.alias("kind")))) \
        .otherwise(F.array().cast("array<struct<line:int,kind:string>>"))
    rows = F.concat(
        head,
        F.transform("andor_lines", lambda x: F.struct(x.alias("line"), F.lit("boolean_operator").alias("kind"))),
        F.transform("else_lines", lambda x: F.struct(x.alias("line"), F.lit("conditional_expression").alias("kind"))))
    return (ll.select(*_FILE, F.explode(rows).alias("d"))
            .select(*_FILE, F.col("d.line").cast("bigint").alias("line"), F.col("d.kind").alias("kind")))
