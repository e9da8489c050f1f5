"""A check of pipeline authors' functions: transforms are pure plans.

They may build DataFrames; they may not touch sessions, files or the network, run
actions, or pass composed strings to SQL."""

from __future__ import annotations

import ast

MODULES = ("os", "sys", "io", "socket", "subprocess", "requests", "urllib", "http", "boto3", "random", "time", "shutil", "pathlib", "threading")
CALLS = ("open", "exec", "eval", "print", "input", "__import__", "compile")
ACTIONS = ("collect", "count", "show", "take", "first", "head", "toPandas", "toLocalIterator", "foreach", "foreachPartition", "write", "writeTo", "writeStream", "cache", "persist", "checkpoint", "localCheckpoint", "createOrReplaceTempView", "sparkSession", "rdd", "getOrCreate")
STRINGS = ("sql", "expr", "selectExpr", "where", "filter")


#: What a grouped frame counts is a plan, not an action.
GROUPS = ("groupBy", "groupby", "rollup", "cube", "groupingSets", "pivot")


def _composed(node: ast.AST) -> bool:
    """Whether an argument is text put together from parts."""
    if isinstance(node, ast.JoinedStr):
        return any(isinstance(x, ast.FormattedValue) for x in node.values)
    if isinstance(node, ast.BinOp) and isinstance(node.op, (ast.Add, ast.Mod)):
        sides = [node.left] if isinstance(node.op, ast.Mod) else [node.left, node.right]
        return any(isinstance(x, ast.Constant) and isinstance(x.value, str) or isinstance(x, ast.JoinedStr) or _composed(x) for x in sides)
    return isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute) and node.func.attr in ("format", "join", "replace") and isinstance(node.func.value, ast.Constant)


def _of_groups(node: ast.Attribute) -> bool:
    return node.attr == "count" and isinstance(node.value, ast.Call) and isinstance(node.value.func, ast.Attribute) and node.value.func.attr in GROUPS


def findings(source: str) -> list[tuple[int, str]]:
    """(line, what) for each forbidden construct."""
    out = []
    for node in ast.walk(ast.parse(source)):
        if isinstance(node, (ast.Import, ast.ImportFrom)):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""]
            out += [(node.lineno, f"import {n}") for n in names if n.split(".")[0] in MODULES]
        elif isinstance(node, ast.Call) and isinstance(node.func, ast.Name) and node.func.id in CALLS:
            out.append((node.lineno, f"{node.func.id}()"))
        elif isinstance(node, ast.Attribute) and node.attr in ACTIONS and not _of_groups(node) and not (isinstance(node.value, ast.Name) and node.value.id in ("F", "functions")):
            out.append((node.lineno, f".{node.attr}"))
        elif isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute) and node.func.attr in STRINGS:
            out += [(node.lineno, f"composed string in .{node.func.attr}") for a in [*node.args, *(k.value for k in node.keywords)] if _composed(a)]
        elif isinstance(node, (ast.Global, ast.Nonlocal)):
            out.append((node.lineno, "global state"))
    return sorted(out)
