"""Settings of the operators, as values that can be replaced."""

from __future__ import annotations

from dataclasses import dataclass, field

NORMAL, ALERTA, ANORMAL, INSUFFICIENT = "Normal", "Alerta", "Anormal", "InsufficientData"
STATUSES = (NORMAL, ALERTA, ANORMAL, INSUFFICIENT)

# Names and limits that results depend on.
VALID_STATES = ("ND", "Operacional Bajo", "Operacional Alto", "Ralenti", "Ralenti Alto", "Ralenti Bajo")
NOT_SIGNALS = ("Fecha", "Unit", "Estado", "EstadoMaquina", "EstadoCarga", "GPSLat", "GPSLon", "GPSElevation", "Week-Year", "EngSpd", "GroundSpd", "Payload")
PERCENTILES = (0.02, 0.05, 0.95, 0.98)
SEVERITY = {NORMAL: 0.0, ALERTA: 0.3, ANORMAL: 1.0}
CRITICALITY = {"High": 1.0, "Medium": 0.4, "Low": 0.2}
RANGES = {
    "GPSLat": (-30.4, -30.1),
    "GPSLon": (-71.3, -70.9),
    "GPSElevation": (400, 2000),
    "GroundSpd": (0, 80),
    "EngSpd": (0, 2500),
    "EngCoolTemp": (30, 120),
    "RAftrclrTemp": (10, 100),
    "EngOilPres": (150, 700),
    "CnkcasePres": (-1.5, 1.5),
    "RtLtExhTemp": (-10, 10),
    "RtExhTemp": (150, 750),
    "LtExhTemp": (150, 750),
    "DiffLubePres": (0, 800),
    "DiffTemp": (0, 150),
    "TrnLubeTemp": (-5, 120),
    "TCOutTemp": (30, 180),
    "RtRBrkTemp": (20, 200),
    "RtFBrkTemp": (20, 200),
    "LtRBrkTemp": (20, 200),
    "LtFBrkTemp": (20, 200),
    "StrgOilTemp": (-10, 150),
}


@dataclass(frozen=True)
class Names:
    """Columns of wide telemetry; ``load`` may be absent from the data."""

    unit: str = "Unit"
    ts: str = "Fecha"
    state: str = "EstadoMaquina"
    load: str = "EstadoCarga"


@dataclass(frozen=True)
class Scoring:
    min_samples: int = 100
    signal_alerta: float = 0.35
    signal_anormal: float = 0.9
    component_alerta: float = 0.15
    component_anormal: float = 0.45
    machine_alerta: float = 0.6
    machine_anormal: float = 1.4
    min_coverage: float = 0.5
    #: A signal weighs in its component if at least this share of its readings is there; None: if it has any.
    min_valid_share: float | None = None


@dataclass(frozen=True)
class Windowing:
    size: int = 60
    step: int = 1
    min_numeric_coverage: float = 0.85
    min_row_coverage: float = 0.95
    max_created_fraction: float | None = 0.10
    max_imputed_fraction: float | None = 0.25
    train_fill: float = 0.0
    predict_fill: float = -10.0


@dataclass(frozen=True)
class Health:
    alpha: float = 1.0
    time_agg: str = "mean"
    signal_agg: str = "rms"
    unit_agg: str = "mean"
    percentile_low: int = 50
    percentile_high: int = 95
    eps: float = 1e-8


@dataclass(frozen=True)
class Component:
    name: str
    signals: tuple[str, ...]
    criticality: str | None = None


@dataclass(frozen=True)
class ComponentMap:
    components: tuple[Component, ...] = field(default=())

    @classmethod
    def of(cls, mapping: dict) -> ComponentMap:
        """From {name: {signals, criticality}}, with or without a ``components`` level above."""
        inner = mapping.get("components", mapping)
        made = []
        for name, item in inner.items():
            level = item.get("criticality")
            made.append(Component(name, tuple(item.get("signals", ())), None if level is None else str(level)))
        return cls(tuple(made))
