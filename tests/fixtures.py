"""Hand-written election fixtures (municipality dimension + results fact).

Cases (see FIXTURES.md): ties in population, votes and turnout; census 0 and
valid 0; unanimous for the first and for the last party; all-null and
some-null party counts; null population; keys on one side only; a group whose
summed winner differs from its largest single row; a unit spread over two
fact rows; accented names.
"""

from __future__ import annotations

from tallyframe.model import Layout

PARTIES = ("pp", "psoe", "podemosiuequo", "cs", "and")
LAYOUT = Layout(unit_id="codigo", unit="municipio", province="provincia", community="comunidad",
                population="poblacion", census="censo", voters="votantes", valid="validos", parties=PARTIES)

DIM_SCHEMA = "codigo BIGINT, municipio STRING, provincia STRING, comunidad STRING, poblacion BIGINT"
FACT_SCHEMA = ("codigo BIGINT, censo BIGINT, votantes BIGINT, validos BIGINT, "
               + ", ".join(f"`{p}` BIGINT" for p in PARTIES))

# codigo, municipio, provincia, comunidad, poblacion
DIM = [
    (1, "Madrid", "Madrid", "Madrid", 3000),
    (2, "Alcalá", "Madrid", "Madrid", 1000),
    (3, "Getafe", "Madrid", "Madrid", 1000),         # population tie with 2
    (4, "Sevilla", "Sevilla", "Andalucía", 2000),
    (5, "Málaga", "Málaga", "Andalucía", 2500),
    (6, "Ávila", "Ávila", "Castilla y León", 500),
    (7, "Soria", "Soria", "Castilla y León", None),   # null population
    (8, "Teruel", "Teruel", "Aragón", 300),
    (9, "Huesca", "Huesca", "Aragón", 300),
    (10, "SoloDim", "Cuenca", "Castilla-La Mancha", 100),  # no results row
    (12, "Vigo", "Pontevedra", "Galicia", 800),
    (13, "Lugo", "Lugo", "Galicia", 400),
    (14, "Ourense", "Ourense", "Galicia", 400),
]

# codigo, censo, votantes, validos, pp, psoe, podemosiuequo, cs, and
FACT = [
    (1, 2000, 1500, 1400, 600, 500, 200, 100, 0),
    (2, 800, 600, 600, 100, 300, 100, 100, 0),
    (3, 800, 600, 600, 600, 0, 0, 0, 0),           # unanimous, first party
    (4, 1500, 1200, 1100, 300, 500, 100, 100, 100),
    (5, 2000, 1200, 1000, 0, 0, 0, 0, 1000),        # unanimous, LAST party (D1)
    (6, 0, 0, 0, 0, 0, 0, 0, 0),                    # census 0, valid 0
    (7, 300, 150, 100, None, None, None, None, None),  # every party null
    (8, 200, 150, 100, 40, None, 40, 20, None),     # some null; tie pp / podemos
    (9, 100, 50, 40, 10, 10, 10, 10, 0),            # spread over two rows ...
    (9, 100, 60, 50, 20, 10, 10, 10, 0),            # ... of the same unit
    (11, 100, 90, 80, 80, 0, 0, 0, 0),              # no dimension row
    # Galicia: the largest single row is Vigo/pp (500) but the summed winner is psoe.
    (12, 1000, 700, 600, 500, 100, 0, 0, 0),
    (13, 500, 400, 350, 50, 300, 0, 0, 0),
    (14, 500, 400, 350, 50, 300, 0, 0, 0),
]


def dim(spark):
    return spark.createDataFrame(DIM, DIM_SCHEMA)


def fact(spark):
    return spark.createDataFrame(FACT, FACT_SCHEMA)


def joined(spark):
    return fact(spark).join(dim(spark), on="codigo", how="inner")
