"""Volume formulas in ``D`` as Columns: numbers, D, + - * / ( ), ** and Math functions. Nothing is evaluated as code."""

from __future__ import annotations

import math
import re
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


class FormulaError(ValueError):
    """A formula with anything but the allowed parts; ``^`` is refused since it isn't a power in the language formulas come from."""


_TOKEN = re.compile(r"\s*(?:(\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+)|(Math\.\w+|D\b)|(\*\*|[-+*/(),]))")
_FUNCTIONS = {"pow": F.pow, "sqrt": F.sqrt, "log": F.log, "exp": F.exp, "abs": F.abs, "min": F.least, "max": F.greatest}
_ARRAYS = {"pow": np.power, "sqrt": np.sqrt, "log": np.log, "exp": np.exp, "abs": np.abs, "min": lambda *x: np.minimum.reduce(np.broadcast_arrays(*x)), "max": lambda *x: np.maximum.reduce(np.broadcast_arrays(*x))}


def parse(text: str, d: Column) -> Column:
    """The formula as a Column over the Column ``d``."""
    return _read(text, d, F.lit, F.try_divide, _FUNCTIONS)


@F.pandas_udf(DoubleType())
def evaluate(text: pd.Series, d: pd.Series) -> pd.Series:
    """Each row's own formula at its ``d``, one formula's rows together; a formula that can't be read gives 0, a value that isn't finite null."""
    out = np.zeros(len(d))
    x = d.to_numpy(float)
    for formula, at in text.groupby(text, dropna=True).indices.items():
        try:
            with np.errstate(all="ignore"):
                out[at] = _read(formula, x[at], np.float64, np.divide, _ARRAYS)
        except FormulaError:
            out[at] = 0.0
    return pd.Series(out).where(np.isfinite(out))


def _read(text: str, d: Any, number, divide, functions: dict) -> Any:
    tokens, at = [], 0
    text = text.strip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise FormulaError(f"can't read {text[at:]!r} in formula {text!r}")
        tokens.append(m.group(m.lastindex))
        at = m.end()
    tokens.append("")
    pos = 0

    def take(expected: str | None = None) -> str:
        nonlocal pos
        token = tokens[pos]
        if expected is not None and token != expected:
            raise FormulaError(f"expected {expected!r}, found {token!r} in formula {text!r}")
        pos += 1
        return token

    def add() -> Column:
        out = multiply()
        while tokens[pos] in ("+", "-"):
            out = out + multiply() if take() == "+" else out - multiply()
        return out

    def multiply() -> Column:
        out = unary()
        while tokens[pos] in ("*", "/"):
            out = out * unary() if take() == "*" else divide(out, unary())
        return out

    def unary() -> Column:
        if tokens[pos] == "-":
            take()
            return -unary()
        return power()

    def power() -> Column:
        base = atom()
        if tokens[pos] == "**":
            take()
            return functions["pow"](base, unary())
        return base

    def atom() -> Column:
        token = take()
        if token == "(":
            out = add()
            take(")")
            return out
        if token == "D":
            return d
        if token.startswith("Math."):
            name = token[5:]
            if name == "PI":
                return number(math.pi)
            if name not in functions:
                raise FormulaError(f"{token} isn't allowed in formula {text!r}")
            take("(")
            args = [add()]
            while tokens[pos] == ",":
                take()
                args.append(add())
            take(")")
            return functions[name](*args)
        if token[:1].isdigit() or token[:1] == ".":
            return number(float(token))
        raise FormulaError(f"unexpected {token or 'end'!r} in formula {text!r}")

    out = add()
    take("")
    return out
