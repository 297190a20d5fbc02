"""Independent DuckDB statements that check the Spark jobs (the driver's oracle)."""

from __future__ import annotations

import re
from pathlib import Path

HERE = Path(__file__).parent


_USD = re.compile(r"@USD\[(.+?)\|(.+?)\]@", re.S)


def usd(amount: str, rate: str) -> str:
    """Exact half-up cents of amount / rate for non-negative amounts, in whole numbers."""
    a = f"CAST(CAST({amount} AS DECIMAL(38,2)) * 100 AS HUGEINT)"
    r = f"CAST(CAST({rate} AS DECIMAL(38,8)) * 100000000 AS HUGEINT)"
    return f"CAST(((2 * {a} * 100000000 + {r}) // (2 * {r})) * 0.01 AS DECIMAL(14,2))"


def expand(text: str) -> str:
    return _USD.sub(lambda m: usd(m.group(1).strip(), m.group(2).strip()), text)


def block(name: str) -> str:
    text = (HERE / f"{name}.sql").read_text()
    return expand("\n".join(line for line in text.splitlines() if not line.lstrip().startswith("--")).strip())


def with_fixtures(body: str, star: bool = True) -> str:
    """Prefix a statement with the shared fixture CTEs (store, then star)."""
    parts = [block("store")]
    if star:
        parts.append(block("star"))
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        body = ",\n" + body[15:]
    elif body.upper().startswith("WITH "):
        body = ",\n" + body[5:]
    else:
        body = "\n" + body
    return "WITH RECURSIVE " + ",\n".join(parts) + expand(body)
