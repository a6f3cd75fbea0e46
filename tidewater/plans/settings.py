"""Per-table load settings (a small driver-side dataclass, validated early)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from tidewater.functions.typemap import SourceColumn
from tidewater.sources.layout import Layout

APPEND, UPSERT, BY_HEADER, FULL_RELOAD, SNAPSHOT = (
    "append", "upsert", "replace_by_header", "full_reload", "daily_snapshot",
)
STRATEGIES = (APPEND, UPSERT, BY_HEADER, FULL_RELOAD, SNAPSHOT)
FREQUENCIES = ("daily", "weekly")


@dataclass(frozen=True)
class InitialLoad:
    """History load settings: windows of ``months`` from ``start`` to ``end``
    (``end`` missing = the run day). Without ``months`` the load is whole."""

    start: date | None = None
    end: date | None = None
    months: int | None = None
    # publish every N windows (None: all windows in one pass). Each slice is
    # its own job and commit, so a failure loses at most one slice of work.
    windows_per_job: int | None = None


@dataclass(frozen=True)
class TableSpec:
    name: str
    strategy: str = FULL_RELOAD
    columns: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    mark_col: str | None = None
    mark_time_col: str | None = None
    local_mark_col: str | None = None
    idempotent: bool = False
    header_table: str | None = None
    header_mark_col: str | None = None
    header_mark_time_col: str | None = None
    doc_key: str | None = None
    header_key: str | None = None
    initial: InitialLoad = field(default_factory=InitialLoad)
    frequency: str = "daily"
    buckets: int = 64
    period_grain: str = "month"
    delete_from: str = "lines"
    # numeric column that splits a JDBC read into parallel ranges: (column, lower, upper, partitions)
    split: tuple[str, int, int, int] | None = None
    # upsert by the MERGE of this catalog table's format instead of rewriting
    # buckets; untested against a live table
    merge_table: str | None = None
    # source catalog rows (S7); when given, the source is cast by the type map
    metadata: tuple[SourceColumn, ...] = ()

    def __post_init__(self):
        if self.strategy not in STRATEGIES:
            # An unknown name must not silently become a truncating reload.
            raise ValueError(f"{self.name}: unknown strategy {self.strategy!r}; expected one of {STRATEGIES}")
        if self.frequency not in FREQUENCIES:
            raise ValueError(f"{self.name}: unknown frequency {self.frequency!r}")
        if self.strategy in (APPEND, UPSERT) and not self.mark_col:
            raise ValueError(f"{self.name}: strategy {self.strategy} needs mark_col")
        if self.strategy == UPSERT and not self.keys:
            raise ValueError(f"{self.name}: upsert needs keys")
        if self.merge_table and self.strategy != UPSERT:
            raise ValueError(f"{self.name}: merge_table is for upsert")
        if self.strategy == BY_HEADER and not (self.header_table and self.header_mark_col and self.doc_key):
            raise ValueError(f"{self.name}: replace_by_header needs header_table, header_mark_col and doc_key")
        if self.delete_from not in ("lines", "headers"):
            raise ValueError(f"{self.name}: delete_from must be 'lines' or 'headers'")
        if self.period_grain not in ("day", "month"):
            raise ValueError(f"{self.name}: period_grain must be 'day' or 'month'")
        m = self.initial.months
        if m is not None and int(m) < 1:
            raise ValueError(f"{self.name}: initial window months must be >= 1, got {m}")

    @property
    def local_mark(self) -> str | None:
        return self.local_mark_col or self.mark_col

    def layout(self) -> Layout:
        """Partitioning that lets each strategy rewrite only what it touches."""
        if self.strategy == UPSERT:
            return Layout("bucket", list(self.keys), self.buckets)
        if self.strategy == BY_HEADER:
            return Layout("bucket", [self.doc_key], self.buckets)
        if self.strategy == SNAPSHOT:
            return Layout("day", day_col="_ingested_at")
        if self.strategy == APPEND:
            return Layout("day", day_col=self.mark_col, grain=self.period_grain)
        return Layout()


def _d(v) -> date | None:
    if v is None or isinstance(v, date):
        return v
    return date.fromisoformat(str(v))


def _split(v) -> tuple[str, int, int, int] | None:
    return None if not v else (str(v["column"]), int(v["lower"]), int(v["upper"]), int(v["partitions"]))


def spec_from_mapping(name: str, cfg: Mapping) -> TableSpec:
    """Build a spec from a plain mapping (e.g. parsed from a config file).

    A missing strategy means full reload; a missing local mark means the mark
    column; an empty column list means every source column.
    """
    ini = cfg.get("initial") or {}
    return TableSpec(
        name=name,
        strategy=cfg.get("strategy") or FULL_RELOAD,
        columns=tuple(cfg.get("columns") or ()),
        keys=tuple(cfg.get("keys") or ()),
        mark_col=cfg.get("mark_col"),
        mark_time_col=cfg.get("mark_time_col"),
        local_mark_col=cfg.get("local_mark_col"),
        idempotent=bool(cfg.get("idempotent", False)),
        header_table=cfg.get("header_table"),
        header_mark_col=cfg.get("header_mark_col"),
        header_mark_time_col=cfg.get("header_mark_time_col"),
        doc_key=cfg.get("doc_key"),
        header_key=cfg.get("header_key"),
        initial=InitialLoad(_d(ini.get("start")), _d(ini.get("end")), ini.get("months"),
                            ini.get("windows_per_job")),
        frequency=cfg.get("frequency") or "daily",
        buckets=int(cfg.get("buckets") or 64),
        period_grain=cfg.get("period_grain") or "month",
        delete_from=cfg.get("delete_from") or "lines",
        split=_split(cfg.get("split")),
        merge_table=cfg.get("merge_table"),
        metadata=tuple(
            SourceColumn(m["name"], m["type"], m.get("length"), m.get("scale"), m.get("position"))
            for m in (cfg.get("metadata") or ())
        ),
    )


# The reference's configuration vocabulary, mapped to ours, so an
# existing table configuration can be loaded as is.
#   keys:       tipo, estrategia, chave_primaria, coluna_watermark,
#               coluna_watermark_ts, coluna_watermark_local, append_idempotente,
#               tabela_cabecalho, coluna_watermark_cabecalho,
#               coluna_watermark_cabecalho_ts, colunas, carga_inicial
#               (inicio, fim, janela_meses), frequencia
#   strategies: incremental_append, incremental_upsert, incremental_via_cabecalho,
#               full_reload, snapshot_diario
#   frequencies: diaria, semanal
#   ingest column: _ingestao_em
#   document key of header-driven lines: DocEntry
REFERENCE_STRATEGIES = {
    "incremental_append": APPEND,
    "incremental_upsert": UPSERT,
    "incremental_via_cabecalho": BY_HEADER,
    "full_reload": FULL_RELOAD,
    "snapshot_diario": SNAPSHOT,
}
REFERENCE_FREQUENCIES = {"diaria": "daily", "semanal": "weekly"}
REFERENCE_INGEST_COL = "_ingestao_em"
REFERENCE_DOC_KEY = "DocEntry"


def spec_from_reference(name: str, cfg: Mapping) -> TableSpec:
    """A spec from one table entry written in the reference's vocabulary.

    A missing strategy is a full reload (as there); an unknown one raises. The
    reference's ingest column maps to ``_ingested_at``; header-driven lines use
    the reference's fixed document key unless ``doc_key`` is given.
    """
    strategy = cfg.get("estrategia") or "full_reload"
    if strategy not in REFERENCE_STRATEGIES:
        raise ValueError(f"{name}: unknown strategy {strategy!r}")
    local = cfg.get("coluna_watermark_local")
    ini = cfg.get("carga_inicial") or {}
    mapped = {
        "strategy": REFERENCE_STRATEGIES[strategy],
        "columns": cfg.get("colunas") or [],
        "keys": cfg.get("chave_primaria") or [],
        "mark_col": cfg.get("coluna_watermark"),
        "mark_time_col": cfg.get("coluna_watermark_ts"),
        "local_mark_col": "_ingested_at" if local == REFERENCE_INGEST_COL else local,
        "idempotent": cfg.get("append_idempotente", False),
        "header_table": cfg.get("tabela_cabecalho"),
        "header_mark_col": cfg.get("coluna_watermark_cabecalho"),
        "header_mark_time_col": cfg.get("coluna_watermark_cabecalho_ts"),
        "doc_key": cfg.get("doc_key") or (REFERENCE_DOC_KEY if strategy == "incremental_via_cabecalho" else None),
        "initial": {"start": ini.get("inicio"), "end": ini.get("fim"), "months": ini.get("janela_meses")},
        "frequency": REFERENCE_FREQUENCIES.get(cfg.get("frequencia") or "diaria", cfg.get("frequencia")),
    }
    return spec_from_mapping(name, mapped)


def specs_from_yaml(text: str, reference_vocabulary: bool = True) -> list[TableSpec]:
    """Table specs, in file order, from YAML text (needs PyYAML)."""
    try:
        import yaml
    except ImportError as exc:  # pragma: no cover - optional dependency
        raise RuntimeError("PyYAML is needed to read YAML settings") from exc
    data = yaml.safe_load(text) or {}
    build = spec_from_reference if reference_vocabulary else spec_from_mapping
    return [build(name, cfg or {}) for name, cfg in data.items()]
