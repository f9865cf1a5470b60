"""Settings of the engine: frozen, with defaults, and rules that hold between them."""

from __future__ import annotations

from dataclasses import dataclass, replace


def listed(value: str | tuple[str, ...]) -> tuple[str, ...]:
    """A comma string as its parts, each once."""
    parts = value.split(",") if isinstance(value, str) else value
    return tuple(dict.fromkeys(p.strip() for p in parts if p.strip()))


@dataclass(frozen=True)
class EngineConfig:
    # Defaults that results depend on.
    centroid_share: float = 0.5
    all_symbols_are_assets: bool = True
    arrows_are_assets: bool = True
    arrow_label: str = "Piping/Fittings/Mid arrow flow direction"
    flow_prefixes: tuple[str, ...] = ("Equipment/", "Piping/Endpoint/Pagination")
    valve_prefix: str = "Instrument/Valve/"
    line_px: float = 50.0
    symbol_px: float = 12.0
    text_px: float = 5.0
    buffer_px: float = 5.0
    close_symbols_px: float = 10.0
    contact_px: float = 2.0
    ray_px: float = 60.0
    close_symbols_overlap: float = 0.7
    prefer_symbols: bool = False
    line_padding: float = 0.2
    axis_only: bool = False
    axis_degrees: float = 5.0
    binary_threshold: int = 240
    thinning: bool = True
    detect_dotted: bool = False
    min_line_px: int | None = 10
    max_gap_px: int | None = None

    def __post_init__(self) -> None:
        fixed = {}
        for name in ("flow_prefixes",):
            fixed[name] = listed(getattr(self, name))
        if self.detect_dotted:
            fixed |= {"min_line_px": None, "max_gap_px": 10 if self.max_gap_px is None else self.max_gap_px}
        else:
            fixed |= {"min_line_px": max(10, self.min_line_px or 10), "max_gap_px": None}
        for name, value in fixed.items():
            object.__setattr__(self, name, value)

    def with_(self, **changes) -> "EngineConfig":
        return replace(self, **changes)
