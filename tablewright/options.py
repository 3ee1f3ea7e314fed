"""Run options of a folder load (the reference's request fields, as a frozen
dataclass)."""

from __future__ import annotations

from dataclasses import dataclass

from .functions.patterns import DEFAULT_SPLIT_THRESHOLD, NA_TOKENS


@dataclass(frozen=True)
class LoadOptions:
    input_path: str
    output_path: str
    ledger_path: str | None = None
    append: bool = False  # multi-part mode: existing tables are upserted into
    row_range: tuple[int, int] | None = None  # half-open [from, to)
    max_rows_per_part: int = DEFAULT_SPLIT_THRESHOLD
    split: bool = False
    profile_only: bool = False
    strict_key: bool = True
    sep: str = ","
    encoding: str | None = None  # None: choose per file (an extra text pass)
    multi_line: bool = False  # cells may hold quoted line breaks
    make_sidecars: bool = False  # write a sidecar for each file that has none
    na_tokens: tuple[str, ...] = NA_TOKENS

    def __post_init__(self):
        if not self.input_path:
            raise ValueError("input_path is required")
        if self.row_range is not None:
            lo, hi = self.row_range
            if lo < 0 or hi < lo:
                raise ValueError("row_range needs 0 <= from <= to")
            if self.split:
                raise ValueError("split and row_range cannot be combined")

    @property
    def ledger(self) -> str:
        return self.ledger_path or self.output_path.rstrip("/") + "/_ledger"
