"""The feed registry as data: which landed dataset, which columns, which row
constraints, which standardizer. A deployment points ``root`` at the folder
where each feed's files land (one sub-folder per feed id)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Feed:
    feed_id: str
    group: str
    variables: tuple[str, ...]
    constraints: dict = field(default_factory=dict)
    time_col: str = "time"
    fmt: str = "parquet"
    protocol: str = "tabledap"
    day_col: str = "day"        # a landed feed may carry the UTC day of each row (a partition column)

    @property
    def iso_times(self) -> bool:
        """Text times begin ``YYYY-MM-DD``: the protocol's only form."""
        return self.protocol == "tabledap"


_OOI_VARS = ("time", "latitude", "longitude", "sea_water_temperature",
             "sea_water_practical_salinity",
             "mole_concentration_of_dissolved_molecular_oxygen_in_sea_water")

# --- fixed values: registered feeds, their variables and row constraints ----
FEEDS: tuple[Feed, ...] = (
    Feed("fixed_gear_oceanography", "cfrf",
         ("time", "latitude", "longitude", "temperature", "dissolved_oxygen", "tow_id")),
    Feed("shelf_fleet_profiles_1m_binned", "cfrf",
         ("time", "latitude", "longitude", "conservative_temperature", "sea_pressure",
          "profile_id", "absolute_salinity")),
    Feed("wind_farm_profiles_1m_binned", "cfrf",
         ("time", "latitude", "longitude", "conservative_temperature", "sea_pressure",
          "profile_id", "absolute_salinity")),
    Feed("wind_farm_acoustic_receivers", "cfrf",
         ("time", "latitude", "longitude", "station_id", "temperature")),
    Feed("demersal_gliders_aggregated", "ioos-gliders",
         ("time", "grid_id", "temperature", "salinity", "dissolved_oxygen", "institution"),
         {"salinity>": 20, "salinity<": 39}),
    Feed("eMOLT_RT", "emolt",
         ("time", "latitude", "longitude", "temperature", "tow_id", "depth"),
         {"segment_type=": 3}),
    Feed("eMOLT_RT_LOWELL", "emolt",
         ("time", "latitude", "longitude", "temperature", "DO", "tow_id"),
         {"water_detect_perc>": 60, "DO>": 0, "temperature>": 0, "temperature<": 27}),
    Feed("ocdbs_v_erddap1", "ecomon",
         ("UTC_DATETIME", "latitude", "longitude", "sea_water_temperature", "pressure_dbars",
          "dissolved_oxygen", "sea_water_salinity", "cast_number", "cruise_id"),
         {"GEAR_TYPE!=": "Bottle", "latitude>": 34}, time_col="UTC_DATETIME"),
    Feed("oleanderXbt", "oleander",
         ("time", "latitude", "longitude", "temp", "depth", "profile_number", "cruise_num"),
         {"hit_bottom=": 1, "latitude>=": 38.18, "latitude<=": 41.04,
          "longitude>=": -74.12, "longitude<=": -71.26, "start_year>": 1999}),
    Feed("ooi-cp11nosm-mfd37-04-dostad000", "ooi", _OOI_VARS),
    Feed("ooi-cp10cnsm-mfd37-04-dostad000", "ooi", _OOI_VARS),
    Feed("ooi-cp11sosm-mfd37-04-dostad000", "ooi", _OOI_VARS),
    Feed("ooi-cp04ossm-mfd37-04-dostad000", "ooi", _OOI_VARS),
    Feed("ooi-cp01cnsm-mfd37-04-dostad000", "ooi", _OOI_VARS),
    Feed("ooi-cp03issm-mfd37-04-dostad000", "ooi", _OOI_VARS),
)

# The previous product is scanned whole for the archive (S9); its location
# is a deployment setting, passed to the runs as ``product_path``.


def feed(feed_id: str) -> Feed:
    for f in FEEDS:
        if f.feed_id == feed_id:
            return f
    raise KeyError(feed_id)
