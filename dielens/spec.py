"""Plan-time naming rules: which columns a request needs and what each one means.

A register's meaning travels in a ``RegisterSpec``; names are derived from it and
never taken apart again later on.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

# Context columns every die table carries, in output order.
CONTEXT_COLUMNS = (
    "FID",
    "DESIGN_ID",
    "PART_TYPE",
    "FAB",
    "RUN_ID",
    "LOT_ID",
    "WAFER_ID",
    "FBD_REGION",
    "REPROBE",
    "START_DATETIME",
    "TOTAL_DIE",
)

# First letter of the design id -> product family.
FAMILY_LETTERS = {
    "DRAM": ("U", "V", "X", "Y", "Z"),
    "NAND": ("B", "F", "G", "L", "M", "N"),
    "3DXP": ("S", "H"),
}
OTHER_FAMILY = "OTHER"

# Name conventions of the die tables.
PROBE_MARK = "rd"
PROBE_COLUMN_PREFIX = "__"
REGISTER_SUFFIX = "_ALL"
FAIL_BIN_STEP = "Fail_bin"
BIN_COLUMN = "BIN_BIT"
ZONE_COLUMN = "FBD_REGION"


@dataclass(frozen=True)
class RegisterSpec:
    """A measured column: its name, the register it reads and the bin it reads it at."""

    name: str
    base: str
    bin: str
    kind: str  # "main", "dependent" or "extra"


@dataclass(frozen=True)
class ProbeSpec:
    """Everything the column plan of one request fixes before any data is read."""

    family: str
    probe_item: str
    bin_step: str | None
    probe_column: str
    dependent_column: str | None
    main: tuple[RegisterSpec, ...]
    dependent: tuple[RegisterSpec, ...] = ()
    extra: tuple[RegisterSpec, ...] = ()
    features: tuple[str, ...] = field(default=())

    @property
    def probe_columns(self) -> list[str]:
        return [c for c in (self.probe_column, self.dependent_column) if c]

    @property
    def registers(self) -> list[str]:
        return [r.name for r in (*self.main, *self.dependent, *self.extra)]

    @property
    def measured(self) -> list[str]:
        """Registers, numeric probe columns and model features, each once."""
        probes = [c for c in self.probe_columns if c not in (BIN_COLUMN, self.bin_step)]
        return unique_names([*self.registers, *probes, *self.features])

    @property
    def scan_columns(self) -> list[str]:
        """Columns to ask the source for, context first."""
        return unique_names([*CONTEXT_COLUMNS, *self.registers, *self.features, *self.probe_columns])

    def with_features(self, features: Iterable[str]) -> ProbeSpec:
        kept = tuple(f for f in unique_names(features) if f != ZONE_COLUMN)
        return ProbeSpec(**{**self.__dict__, "features": kept})


def product_family(design_id: str) -> str:
    """Product family of a design id, by its first letter."""
    for family, letters in FAMILY_LETTERS.items():
        if design_id[:1] in letters:
            return family
    return OTHER_FAMILY


def unique_names(names: Iterable[str]) -> list[str]:
    """Names without case-insensitive repeats; the first spelling wins."""
    first_spelling: dict[str, str] = {}
    for name in names:
        first_spelling.setdefault(name.lower(), name)
    return list(first_spelling.values())


def split_names(text: str | None) -> list[str]:
    """A comma list as trimmed, non-empty names."""
    return [part.strip() for part in (text or "").split(",") if part.strip()]


def missing_features(features: Iterable[str], spec: ProbeSpec) -> list[str]:
    """Model features the request does not read yet; the zone is always there."""
    present = {name.lower() for name in spec.registers}
    return [f for f in unique_names(features) if f != ZONE_COLUMN and f.lower() not in present]


def resolve_spec(
    design_id: str,
    probe_item: str,
    registers: Sequence[str],
    bin_step: str | None = None,
    dependent_item: str | None = None,
    extra: str | Sequence[str] | None = None,
    features: Sequence[str] = (),
) -> ProbeSpec:
    """Turn a user's request into a column plan.

    ``rd<bin>`` reads probe column ``__rd<bin>`` and registers ``<base>_<bin>_ALL``
    (given bare or in full). Any other item needs a ``bin_step``: ``Fail_bin``
    reads ``BIN_BIT``, another step reads the column of that name, and the
    registers are taken as written.
    """
    if probe_item.startswith(PROBE_MARK):
        main_bin = probe_item.removeprefix(PROBE_MARK)
        ending = f"_{main_bin}{REGISTER_SUFFIX}"
        probe_column = PROBE_COLUMN_PREFIX + probe_item
    elif bin_step is not None:
        main_bin = probe_item
        ending = f"_{main_bin}"
        probe_column = BIN_COLUMN if bin_step == FAIL_BIN_STEP else bin_step
    else:
        raise ValueError(f"probe item {probe_item!r} needs a bin step or the {PROBE_MARK!r} mark")

    main = []
    for text in unique_names(r.strip() for r in registers):
        base = text.split(ending)[0]
        bare = base == text and probe_item.startswith(PROBE_MARK)
        main.append(RegisterSpec(text + ending if bare else text, base, main_bin, "main"))

    dependent_column, dependent = None, []
    if dependent_item is not None:
        if not dependent_item.startswith(PROBE_MARK):
            raise ValueError(f"dependent item {dependent_item!r} needs the {PROBE_MARK!r} mark")
        dependent_bin = dependent_item.removeprefix(PROBE_MARK)
        dependent_column = PROBE_COLUMN_PREFIX + dependent_item
        dependent = [
            RegisterSpec(f"{r.base}_{dependent_bin}{REGISTER_SUFFIX}", r.base, dependent_bin, "dependent")
            for r in main
        ]

    taken = {r.name.lower() for r in (*main, *dependent)}
    names = split_names(extra) if isinstance(extra, str) or extra is None else [e.strip() for e in extra]
    extras = [RegisterSpec(n, n, "", "extra") for n in unique_names(names) if n.lower() not in taken]

    spec = ProbeSpec(
        family=product_family(design_id),
        probe_item=probe_item,
        bin_step=bin_step,
        probe_column=probe_column,
        dependent_column=dependent_column,
        main=tuple({r.name.lower(): r for r in reversed(main)}.values())[::-1],
        dependent=tuple({r.name.lower(): r for r in reversed(dependent)}.values())[::-1],
        extra=tuple(extras),
    )
    return spec.with_features(features)
