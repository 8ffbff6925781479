"""Contract expressions: text from a contract to a Spark column, without ``eval``.

Two spellings are accepted: column calls such as ``col('ts').cast(DateType())``
and Spark SQL text inside ``expr('...')``.  Calls outside the fixed lists are refused.
"""

from __future__ import annotations

import ast
import datetime as dt
import operator
import re
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidewater.contracts import FIELD_TYPES
from tidewater.functions.moments import timestamp

# The SQL functions contract expressions may call.
SQL_FUNCTIONS = frozenset(
    """cast try_cast coalesce if nullif concat concat_ws trim lower upper substring left right length
    abs round floor ceil pmod sha2 xxhash64 to_date to_timestamp try_to_timestamp unix_timestamp
    timestamp_millis timestamp_seconds date_from_unix_date date_trunc trunc date_add date_sub datediff
    year month day hour minute current_date current_timestamp in and or not between when then else""".split()
)
FORBIDDEN_MARKS = (";", "--", "/*", "*/")

_OPERATORS = {
    ast.Gt: operator.gt, ast.GtE: operator.ge, ast.Lt: operator.lt, ast.LtE: operator.le,
    ast.Eq: operator.eq, ast.NotEq: operator.ne, ast.Add: operator.add, ast.Sub: operator.sub,
    ast.Mult: operator.mul, ast.Div: operator.truediv, ast.BitAnd: operator.and_, ast.BitOr: operator.or_,
}


class ExpressionError(ValueError):
    """The text is not an allowed contract expression."""


def sql_column(text: str) -> Column:
    """Spark SQL text as a column, after checking every function it calls."""
    if any(mark in text for mark in FORBIDDEN_MARKS):
        raise ExpressionError(f"forbidden characters in {text!r}")
    called = {name.lower() for name in re.findall(r"([A-Za-z_]\w*)\s*\(", text)}
    refused = sorted(called - SQL_FUNCTIONS)
    if refused:
        raise ExpressionError(f"functions {refused} are not allowed in {text!r}")
    _check_tree(text)
    return F.expr(text)


# What a parsed expression may consist of besides calls of the functions above.
PLAIN_NODES = frozenset(
    """UnresolvedAttribute Literal Cast CaseWhen If In IsNull IsNotNull And Or Not Add Subtract Multiply Divide Remainder
    UnaryMinus EqualTo EqualNullSafe GreaterThan GreaterThanOrEqual LessThan LessThanOrEqual Between UnresolvedFunction
    Concat Coalesce Substring StringTrim Like RLike CurrentDate CurrentTimestamp Pmod""".split()
)


def _check_tree(text: str) -> None:
    """Refuse anything but plain operators and listed functions, however they are spelt.

    The parsed tree is walked, so quoted names and subqueries are seen for what they are.
    """
    session = SparkSession.getActiveSession()
    if session is None:
        raise ExpressionError("SQL text in a contract needs a Spark session")
    try:
        tree = session._jsparkSession.sessionState().sqlParser().parseExpression(text)
    except Exception as error:
        raise ExpressionError(f"cannot read {text!r}") from error
    waiting = [tree]
    while waiting:
        node = waiting.pop()
        kind = node.getClass().getSimpleName()
        if kind not in PLAIN_NODES:
            raise ExpressionError(f"{kind} is not allowed in {text!r}")
        if kind == "UnresolvedFunction":
            name = node.nameParts().mkString(".").lower()
            if name not in SQL_FUNCTIONS:
                raise ExpressionError(f"function {name!r} is not allowed in {text!r}")
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]


def contract_column(text: str, batch_id: int, ingest_time: dt.datetime) -> Column:
    """The column a contract expression describes.

    ``current_timestamp()`` and its relatives give the batch's one ingest time,
    so every row of a batch, in every table, carries the same value.  A bare
    unknown name stands for its own text, but for the arguments of ``coalesce``, which are columns.
    """
    calls = {
        "lit": F.lit,
        "col": F.col,
        "coalesce": F.coalesce,
        "when": F.when,
        "to_timestamp": F.to_timestamp,
        "unix_timestamp": lambda c=None: F.unix_timestamp(timestamp(ingest_time) if c is None else c),
        "current_timestamp": lambda: timestamp(ingest_time),
        "current_date": lambda: F.to_date(timestamp(ingest_time)),
        "expr": sql_column,
    }
    methods = {"cast", "otherwise", "when", "isNull", "isNotNull", "alias"}

    def value(node: ast.AST) -> Any:
        match node:
            case ast.Constant():
                return node.value
            case ast.Name(id="batch_id"):
                return batch_id
            case ast.Name():
                return node.id
            case ast.Call(func=ast.Name(id=name), keywords=[]) if name in calls:
                return calls[name](*map(value, node.args))
            case ast.Call(func=ast.Name(id=name), args=[], keywords=[]) if name in FIELD_TYPES:
                return FIELD_TYPES[name]
            case ast.Call(func=ast.Attribute(value=target, attr=name), keywords=[]) if name in methods:
                owner = value(target)
                if not isinstance(owner, Column):
                    raise ExpressionError(f".{name} needs a column in {text!r}")
                return getattr(owner, name)(*map(value, node.args))
            case ast.Compare(ops=[op]) if type(op) in _OPERATORS:
                return _OPERATORS[type(op)](value(node.left), value(node.comparators[0]))
            case ast.BinOp() if type(node.op) in _OPERATORS:
                return _OPERATORS[type(node.op)](value(node.left), value(node.right))
            case ast.UnaryOp(op=ast.USub()):
                return -value(node.operand)
            case ast.UnaryOp(op=ast.Invert()):
                return ~value(node.operand)
        raise ExpressionError(f"not allowed in a contract expression: {ast.unparse(node)!r}")

    try:
        tree = ast.parse(text.strip(), mode="eval")
    except SyntaxError as error:
        raise ExpressionError(f"cannot read expression {text!r}: {error}") from error
    result = value(tree.body)
    return result if isinstance(result, Column) else F.lit(result)
