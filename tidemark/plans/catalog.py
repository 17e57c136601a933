"""Tables and job settings a user of the source project already has.

Fixed values: names and columns must be these for existing readers to keep working.
"""

from __future__ import annotations

# Keyed tables, all text: columns, then the unique key.
KEYED_TABLES = {
    "raw.solar_hourly_energy": ("datetime string, energy string", ["datetime"]),
    "raw.solar_daily_energy": (
        "date string, duration string, total string, co2 string, max string",
        ["date"],
    ),
    "raw.openweather_daily": (
        "date string, cloud_cover_afternoon string, humidity_afternoon string, "
        "precipitation_total string, temperature_min string, temperature_max string, "
        "temperature_afternoon string, temperature_night string, temperature_evening string, "
        "temperature_morning string, pressure_afternoon string, wind_max_speed string, "
        "wind_max_direction string",
        ["date"],
    ),
}

# How those tables are cut, so that a daily delivery rewrites its month and not all history: one more
# column and its expression over the key. Ours; a reader of the named columns does not notice.
KEYED_PARTITIONS = {
    "raw.solar_hourly_energy": ("month", "substring(datetime, 1, 7)"),
    "raw.solar_daily_energy": ("month", "substring(date, 1, 7)"),
    "raw.openweather_daily": ("month", "substring(date, 1, 7)"),
}

# The nested day document that flattens to the columns of the third table.
WEATHER_DOCUMENT = (
    "date string, cloud_cover struct<afternoon: double>, humidity struct<afternoon: double>, "
    "precipitation struct<total: double>, temperature struct<min: double, max: double, "
    "afternoon: double, night: double, evening: double, morning: double>, "
    "pressure struct<afternoon: double>, wind struct<max: struct<speed: double, direction: double>>"
)

# Full-refresh jobs: staging table, target table, bronze CSV below the bronze root.
REFRESH_TABLES = (
    (
        "stg_parlamento_deputados",
        "raw.raw_parlamento_deputados",
        "camara/deputados/parlamento_deputados.csv",
    ),
    (
        "stg_parlamento_senadores_raw",
        "raw.raw_parlamento_senadores",
        "senado/senadores/senadores_senadores.csv",
    ),
    (
        "stg_radar_governismo_deputados_raw",
        "raw.raw_radar_governismo_deputados",
        "radar_congresso/governismo/radar_governismo_deputados.csv",
    ),
    (
        "stg_radar_governismo_senadores",
        "raw.raw_radar_governismo_senadores",
        "radar_congresso/governismo/radar_governismo_senadores.csv",
    ),
    (
        "stg_radar_parlamentares",
        "raw.raw_radar_parlamentares",
        "radar_congresso/parlamentares/radar_parlamentares.csv",
    ),
    (
        "stg_ranking_parlamentares",
        "raw.raw_ranking_parlamentares",
        "ranking/parlamentares/ranking_parlamentares.csv",
    ),
    (
        "stg_ecidadania_bignumbers_raw",
        "raw.raw_ecidadania_bignumbers",
        "ecidadania/big_numbers/ecidadania_bignumbers_consolidado.csv",
    ),
    (
        "stg_ecidadania_mais_votados_raw",
        "raw.raw_ecidadania_mais_votados",
        "ecidadania/mais_votados/ecidadania_mais_votados_consolidado.csv",
    ),
    (
        "stg_ecidadania_paginas_raw",
        "raw.raw_ecidadania_paginas",
        "ecidadania/paginas/ecidadania_paginas_consolidado.csv",
    ),
    (
        "stg_senado_status_raw",
        "raw.raw_senado_status",
        "ecidadania/status/senado_status_consolidado.csv",
    ),
)

# Directory loads: target table to the file type.
BATCH_TARGETS = {
    "raw.atacadao_raw": "csv",
    "raw.vide_raw_home_featured": "json",
    "raw.vide_raw_category_pages": "json",
}

# Tags by which groups of models are refreshed.
MART_TAGS = ("energia", "inflation", "nhl", "vide")

# Marts exported as CSV.
EXPORTED_MARTS = (
    "marts.mrt_governismo_parlamentares",
    "marts.mrt_governismo_parlamentares_trimestral",
    "marts.mrt_obt_parlamentares",
    "marts.mrt_ecidadania_bignumbers",
    "marts.mrt_ecidadania_proposicoes",
    "marts.mrt_energia_clima",
    "marts.mrt_energia_hora",
    "marts.mrt_inflation",
)
