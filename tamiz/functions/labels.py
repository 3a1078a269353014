"""Class labels of the gold layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Growth classes.
STRONG_GROWTH = "Crecimiento fuerte"
MODERATE_GROWTH = "Crecimiento moderado"
STAGNATION = "Estancamiento"
CONTRACTION = "Contracción"

# Name of an industry section by its letter.
SECTORS = {
    "A": "Agricultura, Ganadería y Pesca",
    "B": "Minas y Canteras",
    "C": "Manufactura",
    "D": "Suministro de Energía y Gas",
    "E": "Distribución de Agua y Saneamiento",
    "F": "Construcción",
    "G": "Comercio al por Mayor y Menor",
    "H": "Transporte y Almacenamiento",
    "I": "Alojamiento y Comida",
    "J": "Información y Comunicación",
    "K": "Actividades Financieras y Seguros",
    "L": "Actividades Inmobiliarias",
    "M": "Actividades Profesionales y Científicas",
    "N": "Servicios Administrativos",
    "P": "Enseñanza",
    "Q": "Salud Humana y Asistencia Social",
}
OTHER_SECTOR = "Otras Actividades"

# Fixed value: legal status of a company in business.
ACTIVE = "ACTIVA"


def growth_class(rate: Column) -> Column:
    """Class of a yearly growth rate in percent; a missing rate falls in the last class."""
    return (
        F.when(rate > 2, STRONG_GROWTH)
        .when(rate > 0, MODERATE_GROWTH)
        .when(rate == 0, STAGNATION)
        .otherwise(CONTRACTION)
    )


def sector_name(letter: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in SECTORS.items() for x in pair])
    return F.coalesce(F.try_element_at(names, letter), F.lit(OTHER_SECTOR))


def is_active(status: Column, substring: bool = False) -> Column:
    """Whether a legal status means active. ``substring`` takes any text that contains
    ``activ`` in any case, which also admits ``INACTIVA``."""
    return status.ilike("%activ%") if substring else status == ACTIVE
