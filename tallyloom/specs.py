"""How one operational source is laid out. A further source is one more
``SourceSpec``; no operator changes."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PhoneRule:
    """Accepted pattern; the value kept is ``prefix`` + the text from ``start`` on."""

    pattern: str
    prefix: str = ""
    start: int = 1


# Phone formats.
PHONE_E164 = PhoneRule(r"^\+9639[0-9]{8}$")
PHONE_NATIONAL = PhoneRule(r"^09[0-9]{8}$", prefix="+963", start=2)

# Category domain, as written by a Title-case source.
TITLE_CATEGORIES = {"Internet": "INTERNET", "Voice": "VOICE", "Bundle": "BUNDLE"}
UPPER_CATEGORIES = {"INTERNET": "INTERNET", "VOICE": "VOICE", "BUNDLE": "BUNDLE"}


@dataclass(frozen=True)
class CustomerLayout:
    table: str
    id: str
    name: str
    phone: str
    city: str
    signup: str
    phone_rule: PhoneRule
    city_key: str  # column of the city map that holds this source's spelling


@dataclass(frozen=True)
class ProductLayout:
    table: str
    id: str
    name: str
    category: str
    price: str
    categories: dict[str, str]
    catalog_key: str  # column of the catalog that holds this source's name


@dataclass(frozen=True)
class OrderLayout:
    table: str
    id: str
    customer: str
    product: str
    quantity: str
    price: str
    date: str
    total: str | None = None  # stored total to be verified, if the source has one


@dataclass(frozen=True)
class SourceSpec:
    code: str  # company code, also the source_system of its rows
    customers: CustomerLayout
    products: ProductLayout
    orders: OrderLayout


def source_a(code: str) -> SourceSpec:
    """Integer keys, local-language city and product names, stored total."""
    return SourceSpec(
        code,
        CustomerLayout("customers", "customer_id", "full_name", "phone", "city_ar",
                       "signup_date", PHONE_E164, "ar"),
        ProductLayout("products", "product_id", "product_name", "category", "unit_price",
                      TITLE_CATEGORIES, "local_name"),
        OrderLayout("orders", "order_id", "customer_id", "product_id", "quantity",
                    "unit_price_at_sale", "order_date", "total_price"),
    )


def source_b(code: str) -> SourceSpec:
    """Text keys, English names, no stored total."""
    return SourceSpec(
        code,
        CustomerLayout("clients", "client_id", "client_name", "msisdn", "city_en",
                       "registered_at", PHONE_NATIONAL, "en"),
        ProductLayout("items", "item_id", "item_name", "item_type", "price_syp",
                      UPPER_CATEGORIES, "english_name"),
        OrderLayout("transactions", "tx_id", "client_id", "item_id", "qty",
                    "price_at_tx", "tx_date"),
    )
