"""Formula text to a Spark column: a whitelist over Python's grammar, never eval."""

from __future__ import annotations

import ast
import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_CONSTANTS = {"pi": math.pi, "e": math.e}


def _guard(ok: Column, value: Column, what: str) -> Column:
    return F.when(ok, value).otherwise(F.raise_error(F.lit(f"formula: {what}")).cast("double"))


def _log(x: Column, base: Column | None = None) -> Column:
    out = _guard(x > 0, F.ln(x), "log of a number that is not positive")
    return out if base is None else out / _guard((base > 0) & (base != 1), F.ln(base), "log to that base")


def _round(x: Column, digits: Column | None = None) -> Column:
    return F.bround(x, 0) if digits is None else F.bround(x * F.pow(F.lit(10.0), digits), 0) / F.pow(F.lit(10.0), digits)


_FUNCTIONS: dict[str, Callable[..., Column]] = {
    "abs": F.abs, "fabs": F.abs, "min": F.least, "max": F.greatest, "pow": F.pow, "round": _round, "log": _log,
    "log2": lambda x: _guard(x > 0, F.log2(x), "log2 of a number that is not positive"),
    "log10": lambda x: _guard(x > 0, F.log10(x), "log10 of a number that is not positive"),
    "sqrt": lambda x: _guard(x >= 0, F.sqrt(x), "root of a negative number"),
    "exp": F.exp, "sin": F.sin, "cos": F.cos, "tan": F.tan, "atan": F.atan,
    "asin": lambda x: _guard(F.abs(x) <= 1, F.asin(x), "asin beyond 1"),
    "acos": lambda x: _guard(F.abs(x) <= 1, F.acos(x), "acos beyond 1"),
    "floor": lambda x: F.floor(x).cast("double"), "ceil": lambda x: F.ceil(x).cast("double"),
}


def _divided(a: Column, b: Column) -> Column:
    return _guard(b != 0, a / F.when(b == 0, F.lit(1.0)).otherwise(b), "division by zero")


_OPERATORS: dict[type, Callable[[Column, Column], Column]] = {
    ast.Add: lambda a, b: a + b,
    ast.Sub: lambda a, b: a - b,
    ast.Mult: lambda a, b: a * b,
    ast.Div: _divided,
    ast.FloorDiv: lambda a, b: F.floor(_divided(a, b)).cast("double"),
    ast.Mod: lambda a, b: a - b * F.floor(_divided(a, b)),
    ast.Pow: F.pow,
    ast.Lt: lambda a, b: a < b,
    ast.LtE: lambda a, b: a <= b,
    ast.Gt: lambda a, b: a > b,
    ast.GtE: lambda a, b: a >= b,
    ast.Eq: lambda a, b: a == b,
    ast.NotEq: lambda a, b: a != b,
}


def compile_formula(text: str, names: dict[str, Column]) -> Column:
    """A double column. Names stand for doubles; attributes, subscripts, strings, lambdas and unknown names raise here."""

    def go(node: ast.AST) -> Column:
        match node:
            case ast.Expression(body=body):
                return go(body)
            case ast.Constant(value=bool() | int() | float() as value):
                return F.lit(float(value))
            case ast.Name(id=name) if name in names:
                return names[name]
            case ast.Name(id=name) if name in _CONSTANTS:
                return F.lit(_CONSTANTS[name])
            case ast.BinOp(left=a, op=op, right=b) if type(op) in _OPERATORS:
                return _OPERATORS[type(op)](go(a), go(b))
            case ast.UnaryOp(op=ast.USub(), operand=a):
                return -go(a)
            case ast.UnaryOp(op=ast.UAdd(), operand=a):
                return go(a)
            case ast.Compare(left=a, ops=ops, comparators=others) if all(type(o) in _OPERATORS for o in ops):
                sides = [go(a), *map(go, others)]
                out = F.lit(True)
                for left, op, right in zip(sides, ops, sides[1:], strict=False):
                    out = out & _OPERATORS[type(op)](left, right)
                return out
            case ast.IfExp(test=test, body=a, orelse=b):
                return F.when(go(test), go(a)).otherwise(go(b))
            case ast.Call(func=ast.Name(id=name), args=args, keywords=[]) if name in _FUNCTIONS:
                return _FUNCTIONS[name](*map(go, args))
        raise ValueError(f"not allowed in a formula: {ast.unparse(node)}")

    return go(ast.parse(text, mode="eval"))
