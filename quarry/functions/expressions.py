"""Column expressions and run-date parameters taken from job configs.

Job configs carry expressions as text. Two spellings are accepted:

* ``{"expr": "<Spark SQL expression>"}``: handed to ``F.expr``;
* a string starting with ``F.``: a PySpark expression such as
  ``F.col('qty') * 2`` or ``F.upper(F.col('name')).alias('n')``.

The second form is evaluated by walking its syntax tree. Allowed are the
public functions of ``pyspark.sql.functions`` as ``F.name`` and the types
of ``pyspark.sql.types`` as ``T.name``, methods of Columns and types (and
of what ``F.when`` and windows build from them), Column item access
(``[0]``, ``['key']``), literals and operators. A name is looked up only
directly on ``F`` or ``T`` and only if the module exports it, so neither
imported modules nor functions that take Python code can be reached.
"""

from __future__ import annotations

import ast
import operator
import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Functions that run Python code are no expressions.
_CODE = {"udf", "pandas_udf", "udtf", "arrow_udf", "arrow_udtf"}
_NAMESPACES = {
    "F": {n: getattr(F, n) for n in F.__all__ if n not in _CODE},
    "T": {n: getattr(T, n) for n in T.__all__},
}
_METHODS_OF = (Column, T.DataType)
_BINOPS = {
    ast.Add: operator.add,
    ast.Sub: operator.sub,
    ast.Mult: operator.mul,
    ast.Div: operator.truediv,
    ast.Mod: operator.mod,
    ast.Pow: operator.pow,
    ast.BitAnd: operator.and_,
    ast.BitOr: operator.or_,
}
_CMPOPS = {
    ast.Eq: operator.eq,
    ast.NotEq: operator.ne,
    ast.Lt: operator.lt,
    ast.LtE: operator.le,
    ast.Gt: operator.gt,
    ast.GtE: operator.ge,
}
_UNARY = {ast.Invert: operator.invert, ast.USub: operator.neg, ast.Not: operator.invert}


def _name(node: ast.Attribute):
    """``F.x`` and ``T.x`` from the exported names, else a public method of
    a Column or a type."""
    if isinstance(node.value, ast.Name):
        names = _NAMESPACES.get(node.value.id, {})
        if node.attr not in names:
            raise ValueError(f"{node.value.id}.{node.attr} is not allowed")
        return names[node.attr]
    value = _eval(node.value)
    if node.attr.startswith("_") or not isinstance(value, _METHODS_OF):
        raise ValueError(f"attribute {node.attr!r} is not allowed")
    method = getattr(type(value), node.attr, None)
    if not callable(method):
        raise ValueError(f"{node.attr!r} is no method of {type(value).__name__}")
    return getattr(value, node.attr)


def _eval(node):
    if isinstance(node, ast.Expression):
        return _eval(node.body)
    if isinstance(node, ast.Constant):
        return node.value
    if isinstance(node, (ast.List, ast.Tuple)):
        items = [_eval(e) for e in node.elts]
        return items if isinstance(node, ast.List) else tuple(items)
    if isinstance(node, ast.Dict):
        return {_eval(k): _eval(v) for k, v in zip(node.keys, node.values)}
    if isinstance(node, ast.Attribute):
        return _name(node)
    if isinstance(node, ast.Call):
        if not isinstance(node.func, ast.Attribute):
            raise ValueError("only F., T. and methods may be called")
        func = _name(node.func)
        args = [_eval(a) for a in node.args]
        kwargs = {k.arg: _eval(k.value) for k in node.keywords}
        return func(*args, **kwargs)
    if isinstance(node, ast.Subscript):
        # Column item access: array element, map value or struct field.
        value = _eval(node.value)
        if not isinstance(value, Column):
            raise ValueError("only Columns may be indexed")
        return value[_eval(node.slice)]
    if isinstance(node, ast.BinOp) and type(node.op) in _BINOPS:
        return _BINOPS[type(node.op)](_eval(node.left), _eval(node.right))
    if isinstance(node, ast.UnaryOp) and type(node.op) in _UNARY:
        return _UNARY[type(node.op)](_eval(node.operand))
    if isinstance(node, ast.Compare) and len(node.ops) == 1 and type(node.ops[0]) in _CMPOPS:
        return _CMPOPS[type(node.ops[0])](_eval(node.left), _eval(node.comparators[0]))
    raise ValueError(f"unsupported expression element: {ast.dump(node)[:80]}")


def pyspark_expression(text: str):
    """Evaluate an ``F.``-expression string (see module docstring)."""
    return _eval(ast.parse(text.strip(), mode="eval"))


def config_value(value):
    """Turn one config argument into what a DataFrame method expects."""
    if isinstance(value, str) and value.startswith("F."):
        return pyspark_expression(value)
    if isinstance(value, dict) and set(value) == {"expr"}:
        return F.expr(value["expr"])
    return value


def as_column(value) -> Column:
    """A config value as a Column: ``F.`` text, ``{"expr"}`` or SQL text."""
    value = config_value(value)
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.expr(value)
    return F.lit(value)


# Placeholders the job configs use for the run date (fixed spellings):
#   ${run_date}   substituted as written (catalog SQL query, JDBC table)
#   {$run_date}   substituted as a quoted literal (SQL-file transform)
#   :run_date     Spark SQL named parameter (preferred)
_QUOTED = re.compile(r"""(['"])(\$\{run_date\}|\{\$run_date\})\1""")
_BARE = re.compile(r"\$\{run_date\}|\{\$run_date\}")
_EMBEDDED = re.compile(r"[A-Za-z0-9_]\$\{run_date\}|\$\{run_date\}[A-Za-z0-9_]")
_LITERAL = re.compile(r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*\"""")
_TYPED = re.compile(r"\b(DATE|TIMESTAMP_NTZ|TIMESTAMP_LTZ|TIMESTAMP)\s*(['\"])(?:\$\{run_date\}|\{\$run_date\})\2", re.IGNORECASE)
_PLACEHOLDERS = ("${run_date}", "{$run_date}")


def _fill_literal(literal: str, run_date) -> str:
    if literal[1:-1] in _PLACEHOLDERS:  # the whole literal: bound as a parameter
        return literal
    for p in _PLACEHOLDERS:
        literal = literal.replace(p, str(run_date))
    return literal


def bind_run_date(sql_text: str, run_date) -> tuple[str, dict]:
    """Rewrite run-date placeholders into a ``:run_date`` parameter.

    Returns the text and the ``args`` for ``spark.sql``. A placeholder glued
    to an identifier (``orders_${run_date}``) is substituted as text, since
    parameters cannot name objects. With no run date, text is unchanged.
    """
    if run_date is None:
        return sql_text, {}
    if _EMBEDDED.search(sql_text):
        sql_text = sql_text.replace("${run_date}", str(run_date))
    # Inside a longer string literal ('${run_date} 12:00', '%${run_date}%')
    # the date is part of the text: substitute it there.
    sql_text = _LITERAL.sub(lambda m: _fill_literal(m.group(0), run_date), sql_text)
    # A typed literal (DATE '${run_date}') becomes a cast of the parameter.
    sql_text = _TYPED.sub(lambda m: f"CAST(:run_date AS {m.group(1)})", sql_text)
    text = _QUOTED.sub(":run_date", sql_text)
    text = _BARE.sub(":run_date", text)
    if re.search(r":run_date\b", text):
        value = run_date if isinstance(run_date, int) else str(run_date)
        return text, {"run_date": value}
    return text, {}


def substitute_run_date(text: str, run_date) -> str:
    """Plain text substitution of the placeholders for source-side SQL
    (a JDBC ``dbtable`` subquery runs in the source database, where Spark
    parameters do not exist)."""
    if run_date is None:
        return text
    for p in _PLACEHOLDERS:
        text = text.replace(p, str(run_date))
    return text
