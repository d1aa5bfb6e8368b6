"""Declarative specs that drive the generic operators.

One :class:`EntitySpec` replaces a whole hand-written cleaning notebook: the
same operators run for customers, products, sales lines or any other table
(e.g. ``lineitem`` with a composite key) by changing the spec only.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Recode:
    """Code standardisation for one column.

    ``mapping`` maps a target value to the source codes that become it, in
    priority order (first match wins).  ``null_default`` / ``blank_default``
    replace NULL / blank (after trim) values; ``otherwise`` is ``"keep"`` (the
    value as is) or ``"trim"`` (the trimmed value).
    """

    mapping: tuple[tuple[str, tuple[str, ...]], ...]
    null_default: str | None = None
    blank_default: str | None = None
    handle_null: bool = False
    handle_blank: bool = False
    otherwise: str = "keep"


def recode(mapping: dict[str, list[str] | str], *, null_default=None, blank_default=None,
           handle_null=None, handle_blank=None, otherwise="keep") -> Recode:
    pairs = tuple((tgt, tuple([src] if isinstance(src, str) else src)) for tgt, src in mapping.items())
    return Recode(
        mapping=pairs,
        null_default=null_default,
        blank_default=blank_default,
        handle_null=(null_default is not None) if handle_null is None else handle_null,
        handle_blank=(blank_default is not None) if handle_blank is None else handle_blank,
        otherwise=otherwise,
    )


@dataclass(frozen=True)
class EntitySpec:
    """How to profile and clean one bronze table into its silver form."""

    name: str
    key: tuple[str, ...]                      # primary key (composite allowed)
    order_col: str | None = None              # "latest wins" column for dedupe
    natural_key: tuple[str, ...] = ()         # second key checked for duplicates
    score_cols: tuple[str, ...] | None = None # completeness score columns (default: all non-key)
    categorical: tuple[str, ...] = ()         # columns profiled as distributions
    date_cols: tuple[str, ...] = ()           # columns profiled as date ranges
    end_col: str | None = None                # end date paired with order_col (validity interval)
    fills: tuple[tuple[str, object], ...] = ()        # NULL -> value, per column
    recodes: tuple[tuple[str, Recode], ...] = ()      # code standardisation, per column
    renames: tuple[tuple[str, str], ...] = ()         # old -> new, defines output order
    keep_null_keys: bool = False              # keep NULL-key rows (False: junk rows are dropped)
    blank_as_null: bool = False               # treat '' (after trim) as NULL before fills

    @property
    def rename_map(self) -> dict[str, str]:
        return dict(self.renames)


@dataclass(frozen=True)
class IngestSource:
    file_name: str
    table_name: str
    description: str = ""


@dataclass(frozen=True)
class IngestConfig:
    """Config-driven ingest: a base folder, a target schema and a list of sources."""

    base_path: str
    target_schema: str
    sources: tuple[IngestSource, ...] = field(default_factory=tuple)

    @staticmethod
    def from_json(path: str) -> "IngestConfig":
        """Load a config from a JSON file (data only; nothing is executed)."""
        import json

        with open(path, encoding="utf-8") as fh:
            return IngestConfig.from_dict(json.load(fh))

    @staticmethod
    def from_dict(d: dict) -> "IngestConfig":
        return IngestConfig(
            base_path=d["base_path"],
            target_schema=d["target_schema"],
            sources=tuple(IngestSource(**s) for s in d["sources"]),
        )


@dataclass(frozen=True)
class DqRule:
    """A PASS / WARN / FAIL threshold rule over one named metric (higher is worse)."""

    check_name: str
    metric: str
    warn: float
    fail: float
