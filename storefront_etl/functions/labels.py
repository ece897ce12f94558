"""Value -> group label mapping as a native CASE expression.

A mapping is an ordered sequence of ``(label, values)`` pairs; the first
group whose value list contains the input wins, anything else (including
NULL) gets the default.  Matching is exact and case-sensitive.  The whole
mapping is one CASE expression inside whole-stage codegen, with no Python
worker; Catalyst turns any list of more than 10 values into a hash-set
lookup (``InSet``), so large mappings stay cheap per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# ---------------------------------------------------------------------------
# These lists must equal the source job's lists for identical
# results.  Kept in the job's own order; the region default is 'sul' and the
# category default is 'outros' (the job never consults its 'sul' and 'outros'
# lists, so NULL and unknown values also land on the default).
# ---------------------------------------------------------------------------
REGION_GROUPS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("norte", ("ac", "am", "ro", "rr", "ap", "to", "pa")),
    ("nordeste", ("ma", "pi", "ce", "rn", "pb", "pe", "al", "ba", "se")),
    ("centro-oeste", ("mt", "ms", "df", "go")),
    ("sudeste", ("mg", "sp", "es", "rj")),
)
REGION_SOUTH_STATES: tuple[str, ...] = ("pr", "sc", "rs")
REGION_DEFAULT = "sul"

CATEGORY_GROUPS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("eletronicos e tecnologia", (
        "pcs", "pc_gamer", "tablets_impressao_imagem", "telefonia_fixa",
        "telefonia", "informatica_acessorios", "eletronicos", "audio",
        "consoles_games", "dvds_blu_ray")),
    ("moda e acessorios", (
        "fashion_roupa_masculina", "fashion_roupa_feminina",
        "fashion_roupa_infanto_juvenil", "fashion_underwear_e_moda_praia",
        "fashion_bolsas_e_acessorios", "fashion_calcados", "fashion_esporte")),
    ("casa e decoracao", (
        "moveis_decoracao", "moveis_colchao_e_estofado",
        "moveis_cozinha_area_de_servico_jantar_e_jardim", "moveis_quarto",
        "moveis_sala", "utilidades_domesticas", "cama_mesa_banho",
        "casa_construcao", "casa_conforto", "casa_conforto_2")),
    ("livros e educacao", (
        "livros_tecnicos", "livros_importados", "livros_interesse_geral")),
    ("beleza e saude", ("beleza_saude", "fraldas_higiene", "perfumaria")),
    ("brinquedos e jogos", ("brinquedos", "jogos", "instrumentos_musicais")),
    ("alimentos_e_bebidas", ("alimentos_bebidas", "bebidas", "alimentos")),
    ("artigos para festas", ("artigos_de_festas", "artigos_de_natal")),
    ("arte e artesanato", ("artes", "cine_foto", "artes_e_artesanato")),
    ("ferramentas e construcao", (
        "construcao_ferramentas_construcao", "construcao_ferramentas_seguranca",
        "construcao_ferramentas_jardim", "construcao_ferramentas_iluminacao",
        "construcao_ferramentas_ferramentas")),
    ("esporte e lazer", ("esporte_lazer",)),
)
CATEGORY_OTHER: tuple[str, ...] = (
    "cool_stuff", "flores", "industria_comercio_e_negocios", "malas_acessorios",
    "seguros_e_servicos", "market_place", "relogios_presentes", "papelaria",
    "climatizacao", "sinalizacao_e_seguranca", "agro_industria_e_comercio",
    "cds_dvds_musicais", "musica", "eletroportateis",
)
CATEGORY_DEFAULT = "outros"
# ---------------------------------------------------------------------------


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_labels(
    c: ColumnOrName,
    groups: Iterable[tuple[str, Sequence[str]]],
    default: str | None,
) -> Column:
    """CASE WHEN c IN (...) THEN label ... ELSE default END (first group wins)."""
    src = _col(c)
    expr: Column | None = None
    for label, values in groups:
        cond = src.isin(list(values))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    fallback = F.lit(default).cast("string")
    return fallback if expr is None else expr.otherwise(fallback)


def region_of_state(c: ColumnOrName) -> Column:
    """State code -> region label; anything unlisted (and NULL) -> 'sul'."""
    return map_labels(c, REGION_GROUPS, REGION_DEFAULT)


def category_group(c: ColumnOrName) -> Column:
    """Product category -> group label; anything unlisted (and NULL) -> 'outros'."""
    return map_labels(c, CATEGORY_GROUPS, CATEGORY_DEFAULT)
