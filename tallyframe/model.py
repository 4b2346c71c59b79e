"""Column roles of a results table.

A results table has one row per reporting *unit* (a municipality, a customer),
the unit's place in a two-level hierarchy (province inside community), a size
measure (population), three nested counts (census >= voters >= valid) and one
count column per *party* (category).  Operators never hard-code these names;
they read them from a :class:`Layout`.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Layout:
    unit_id: str = "unit_id"
    unit: str = "unit"
    province: str = "province"
    community: str = "community"
    population: str = "population"
    census: str = "census"
    voters: str = "voters"
    valid: str = "valid"
    parties: tuple[str, ...] = field(default_factory=tuple)

    def with_parties(self, parties) -> "Layout":
        return replace(self, parties=tuple(parties))

    @property
    def place_cols(self) -> list[str]:
        return [self.unit_id, self.unit, self.province, self.community]


# ---------------------------------------------------------------------------
# The 2016 Spanish general-election results file.  These are the
# party column names of that file after header cleaning (non [a-zA-Z0-9_]
# characters deleted, lower-cased), in the file's own column order, which is
# also the tie-break order for "first party wins".
# ---------------------------------------------------------------------------
SPAIN_2016_PARTIES = (
    "pp", "psoe", "podemosiuequo", "cs", "ecp", "podemoscompromseupv", "erccats", "cdc",
    "podemosenmareaanovaeu", "eajpnv", "ehbildu", "ccapnc", "pacma", "recortescerogrupoverde",
    "upyd", "vox", "bngns", "pcpe", "gbai", "eb", "fedelasjons", "si", "somval", "ccd", "sain",
    "ph", "centromoderado", "plib", "ccdci", "upl", "pcoe", "and", "jxc", "pfyv", "cilus", "pxc",
    "mas", "izar", "unidaddelpueblo", "prepal", "ln", "repo", "independientesfia", "entaban",
    "imc", "puede", "fe", "alcd", "fme", "hrtsln", "udt",
)

# The two province cohorts compared in the report ("empty" and
# "full" Spain), as written by the analyst (accents are folded before matching).
SPAIN_EMPTY_PROVINCES = ("Soria", "Teruel", "Cuenca", "Zamora", "Palencia", "Ávila", "Segovia")
SPAIN_FULL_PROVINCES = ("Madrid", "Barcelona", "Valencia", "Sevilla", "Málaga")

# Column names of the municipality dimension and the results fact after header
# cleaning.
SPAIN_2016 = Layout(
    unit_id="codigo",
    unit="municipio",
    province="provincia",
    community="comunidad",
    population="poblacion",
    census="censo",
    voters="votantes",
    valid="validos",
    parties=SPAIN_2016_PARTIES,
)
