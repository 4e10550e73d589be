"""Calculator modules, transaction types and the qualification rules of the two mailing hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The last two segments of the calculator module names.
ADDITIONAL_PAGES = "LetterShop.AdditionalPagesLineItemCalculator"
DUPLEX = "LetterShop.DuplexLineItemCalculator"
INSERTS = "LetterShop.InsertsLineItemCalculator"
LETTER_SHOP = "LetterShop.LetterShopLineItemCalculator"
ADDITIONAL_POSTAGE_INTERNATIONAL = "Postage.AdditionalPostageInternationalLineItemCalculator"
ADDITIONAL_POSTAGE = "Postage.AdditionalPostageLineItemCalculator"
FORCE_MAIL_POSTAGE = "Postage.ForceMailPostageLineItemCalculator"
FORCE_MAIL_SPECIAL_HANDLING = "Postage.ForceMailSpecialHandlingPostageLineItemCalculator"
INTERNATIONAL_POSTAGE_CANADA = "Postage.InternationalPostageCanadaLineItemCalculator"
INTERNATIONAL_POSTAGE = "Postage.InternationalPostageLineItemCalculator"
POSTAGE = "Postage.PostageLineItemCalculator"

# Transaction type of each calculator module.
TYPE_GUID = {
    LETTER_SHOP: "7cd5755a-3827-4d05-ac9e-fe40322947e5",
    INSERTS: "39362017-6b1e-4d75-90a2-75fd0e422756",
    DUPLEX: "3fa59b34-b073-47bb-b196-5541e7367e2a",
    ADDITIONAL_PAGES: "0a970d9c-fdf0-4a67-ae30-ecdf3c37e1e6",
    POSTAGE: "032c0ea6-de40-489e-9889-459e88fff1e8",
    FORCE_MAIL_POSTAGE: "032c0ea6-de40-489e-9889-459e88fff1e8",
    INTERNATIONAL_POSTAGE: "981259db-bc3e-462a-8819-1a793dca9ca5",
    INTERNATIONAL_POSTAGE_CANADA: "981259db-bc3e-462a-8819-1a793dca9ca5",
    FORCE_MAIL_SPECIAL_HANDLING: "1ef4110f-47d7-4c54-bbed-d037eb6b3ddf",
    ADDITIONAL_POSTAGE: "f4a7f8fa-966e-4140-ae08-77d03e9434e4",
    ADDITIONAL_POSTAGE_INTERNATIONAL: "5e9dcb63-78ae-415a-9100-5a6d0c0f6d77",
}

# Status of a new batch, status of a generated transaction (excluded) and its location.
NEW_BATCH_STATUS_ID = "7bb2234c-2eec-4ac3-bba0-e4f9ef019e9c"
EXCLUDED_STATUS_ID = 3
LOCATION_ID = 4

# Rate types whose amount is spread over the delivery points.
FIXED_RATE_TYPES = (6, 8)

UNKNOWN_HOST, HOST1, HOST2 = 0, 1, 2

# Modules that count every detail once, per host.
_COUNT_ALL = {
    HOST1: (LETTER_SHOP, ADDITIONAL_POSTAGE, ADDITIONAL_PAGES, INSERTS, DUPLEX),
    HOST2: (LETTER_SHOP, POSTAGE, ADDITIONAL_POSTAGE, INSERTS),
}
_FORCE_MAIL = (FORCE_MAIL_POSTAGE, FORCE_MAIL_SPECIAL_HANDLING)
_INTERNATIONAL = (INTERNATIONAL_POSTAGE, ADDITIONAL_POSTAGE_INTERNATIONAL)

SUPPORTED = {
    HOST1: (*_COUNT_ALL[HOST1], POSTAGE, *_INTERNATIONAL, INTERNATIONAL_POSTAGE_CANADA, *_FORCE_MAIL),
    HOST2: (*_COUNT_ALL[HOST2], ADDITIONAL_PAGES, DUPLEX, *_FORCE_MAIL),
}

_RULED = ("country", "is_foreign", "is_force_mailed", "is_active", "page_count", "paper_page_count")

_KNOWN = tuple(sorted({module for modules in SUPPORTED.values() for module in modules}))


def module_key(module: Column) -> Column:
    """Last two segments of a dotted module name; the rules are keyed by them."""
    return F.substring_index(module, ".", -2)


def module_number(module: Column) -> Column:
    """Number of a module that some rule knows, 0 for any other: shorter to shuffle than its name."""
    return F.coalesce(F.array_position(F.array(*[F.lit(m) for m in _KNOWN]), module_key(module)), F.lit(0)).cast("int")


def numbered_module(number: Column) -> Column:
    """``module_key`` of a ``module_number``, NULL for 0."""
    return F.get(F.array(*[F.lit(m) for m in _KNOWN]), number - 1)


def type_guid(module: Column) -> Column:
    """Transaction type of a module, NULL for an unknown one."""
    pairs = [F.lit(part) for item in TYPE_GUID.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), module_key(module))


def is_supported(host: Column, module: Column) -> Column:
    """True where the host has a rule for the module."""
    key = module_key(module)
    return F.coalesce(
        F.when(host == HOST1, key.isin(*SUPPORTED[HOST1])).when(host == HOST2, key.isin(*SUPPORTED[HOST2])),
        F.lit(False),
    )


def ruled_columns(table: DataFrame) -> list[Column]:
    """What the rules read of a host's piece records; of the country only whether it is Canada."""
    canada = F.when(_is_canada(F.col("country")), "CANADA").alias("country") if "country" in table.columns else None
    return [canada if c == "country" else F.col(c) for c in table.columns if c in _RULED]


def _is_canada(country: Column) -> Column:
    return F.upper(F.rtrim(country)) == "CANADA"


def host1_quantity(key: Column, piece: Column) -> Column:
    """Billable quantity of one detail on host 1, NULL where it does not qualify.

    ``piece`` is the host's piece record, NULL if it has none; rules that read it then do not qualify.
    """
    foreign = piece["is_foreign"] == F.lit(True)
    canada = _is_canada(piece["country"])
    return (
        F.when(key.isin(*_COUNT_ALL[HOST1]), 1)
        .when((key == POSTAGE) & (piece["is_active"] == F.lit(True)), 1)
        .when(key.isin(*_INTERNATIONAL) & foreign, 1)
        .when((key == INTERNATIONAL_POSTAGE_CANADA) & foreign & canada, 1)
        .when(key.isin(*_FORCE_MAIL) & (piece["is_force_mailed"] == F.lit(True)), 1)
        .cast("bigint")
    )


def host2_quantity(key: Column, piece: Column) -> Column:
    """As ``host1_quantity`` for host 2, where page counts set the quantity of two modules."""
    pages, sheets = piece["page_count"], piece["paper_page_count"]
    return (
        F.when(key.isin(*_COUNT_ALL[HOST2]), F.lit(1))
        .when((key == ADDITIONAL_PAGES) & (pages > 1), sheets - 1)
        .when((key == DUPLEX) & (pages - sheets > 0), pages - sheets)
        .when(key.isin(*_FORCE_MAIL) & (piece["is_force_mailed"] == F.lit(True)), F.lit(1))
        .cast("bigint")
    )
