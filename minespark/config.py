"""Settings from an .env file: one immutable object, passed explicitly."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields
from pathlib import Path


@dataclass(frozen=True)
class Config:
    """Where tables and results live and how monthly jobs run. Secrets stay in the environment and are never shown."""

    mode: str = "parquet"
    data_dir: str = "data"
    out_dir: str = "out"
    database: str = "default"
    jdbc_url: str = ""
    jdbc_user: str = ""
    jdbc_password: str = ""
    col_month: str = "acct_month"
    col_id: str = "user_no"
    n_recent: int = 3
    iv_limit: float = 0.2
    r_limit: float = 0.8
    psi_limit: float = 0.1
    shuffle_partitions: int = 200
    shared_dir: str = ""

    def shown(self) -> dict[str, object]:
        """All settings, secrets masked."""
        return {f.name: "***" if "password" in f.name and getattr(self, f.name) else getattr(self, f.name) for f in fields(self)}


def load_config(path: str | Path | None = None, environ: dict[str, str] | None = None) -> Config:
    """Defaults, over them the KEY=VALUE lines of the file, over them the environment (MINESPARK_ before the key)."""
    values: dict[str, str] = {}
    if path is not None:
        for line in Path(path).read_text(encoding="utf-8").splitlines():
            line = line.strip()
            if line and not line.startswith("#"):
                k, sign, v = line.partition("=")
                if not sign:
                    raise ValueError(f"no KEY=VALUE: {line}")
                values[k.strip().lower()] = v.strip().strip("'\"")
    values |= {k.removeprefix("MINESPARK_").lower(): v for k, v in (os.environ if environ is None else environ).items() if k.startswith("MINESPARK_")}
    kinds = {f.name: type(f.default) for f in fields(Config)}
    unknown = set(values) - set(kinds)
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    return Config(**{k: kinds[k](v) for k, v in values.items()})
