"""Small programs run apart from the workers: a child process with limits, given INPUTS, returning `result`."""

from __future__ import annotations

import json
import subprocess
import sys
import time
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import pandas as pd
from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Limits:
    seconds: int = 6
    code_chars: int = 6000
    output_chars: int = 4000
    result_chars: int = 1000
    memory_mb: int = 256


# Modules that a program may import.
MODULES = ("collections", "datetime", "decimal", "fractions", "functools", "itertools", "json", "math", "random", "re", "statistics")

_CHILD = """
import builtins, io, json, resource, sys
job = json.loads(sys.stdin.read())
cap = job["memory_mb"] << 20
resource.setrlimit(resource.RLIMIT_AS, (cap, cap))
resource.setrlimit(resource.RLIMIT_CPU, (job["seconds"], job["seconds"]))
resource.setrlimit(resource.RLIMIT_NOFILE, (16, 16))
allowed, given = set(job["modules"]), builtins.__import__
loaded = {name: given(name) for name in sorted(allowed)}

def checked(name, *rest, **more):
    if name.split(".")[0] not in allowed:
        raise ImportError("not allowed: " + name)
    return given(name, *rest, **more)

def refused(*_, **__):
    raise PermissionError("not allowed")

names = {k: v for k, v in vars(builtins).items() if k not in ("open", "exec", "eval", "compile", "input", "breakpoint", "exit", "quit", "help")}
names.update(__import__=checked, open=refused)
said, own = io.StringIO(), sys.stdout
sys.stdout = said
space = {"__builtins__": names, "INPUTS": job["inputs"], "__name__": "program"}
try:
    exec(compile(job["code"], "program", "exec"), space)
    status, error = "ok", ""
except BaseException as e:
    status, error = "error", type(e).__name__ + ": " + str(e)
sys.stdout = own
print(json.dumps({"status": status, "error": error, "result": None if space.get("result") is None else str(space["result"]), "stdout": said.getvalue()}))
"""


def run_program(code: str, inputs: dict, limits: Limits = Limits()) -> dict:
    """status (ok, error, timeout, rejected), result_text, stdout, error and elapsed_ms of one program."""
    began = time.monotonic()
    out = {"status": "rejected", "result_text": None, "stdout": "", "error": "code is empty or too long"}
    if code and len(code) <= limits.code_chars:
        job = json.dumps({"code": code, "inputs": inputs, "modules": MODULES, **asdict(limits)})
        try:
            done = subprocess.run([sys.executable, "-I", "-S", "-c", _CHILD], input=job, capture_output=True, text=True, timeout=limits.seconds + 2, env={})
            told = json.loads(done.stdout.splitlines()[-1]) if done.stdout.strip() else {"status": "error", "error": f"ended with {done.returncode}", "result": None, "stdout": ""}
            result = told["result"]
            out = {"status": told["status"], "result_text": result and result[: limits.result_chars], "stdout": told["stdout"][: limits.output_chars], "error": told["error"][: limits.output_chars]}
        except subprocess.TimeoutExpired:
            out |= {"status": "timeout", "error": f"more than {limits.seconds} s"}
    return out | {"elapsed_ms": int((time.monotonic() - began) * 1000)}


def replay(items: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(ord, status, result_text, matches) for rows (ord, code, inputs, answer): inputs is a map of strings, given as
    numbers where they are numbers; matches says whether the result is the answer."""

    def number(text: str) -> object:
        try:
            return json.loads(text.replace(",", ""))
        except ValueError:
            return text

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for ord_, code, inputs, answer in batch.itertuples(index=False):
                done = run_program(code or "", {k: number(v) for k, v in dict(inputs or {}).items()}, limits)
                matches = done["status"] == "ok" and (done["result_text"] or "").strip() == (answer or "").strip()
                rows.append((ord_, done["status"], done["result_text"], matches))
            yield pd.DataFrame(rows, columns=["ord", "status", "result_text", "matches"])

    return items.select("ord", "code", "inputs", "answer").mapInPandas(run, "ord long, status string, result_text string, matches boolean")
