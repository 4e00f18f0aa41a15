"""Parameters of the three stages; the defaults are the contract's constants."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Sampling:
    start_s: float = 40.0
    end_s: float | None = None
    interval_s: float = 3.0
    target_size: int = 186
    max_deviation: float = 0.03
    default_fps: float = 30.0


@dataclass(frozen=True)
class Grid:
    cells: int = 20
    cell_px: float = 9.3


@dataclass(frozen=True)
class Table:
    start_s: int = 40
    cell_s: int = 15
    rows: int = 6
    columns: int = 17
    empty: str = "EM"
    unmapped: str = "UN"
    separator: str = "_"

    @property
    def column_s(self) -> int:
        return self.cell_s * self.rows
