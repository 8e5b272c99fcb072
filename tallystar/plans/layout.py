"""Names of the sales data."""

from __future__ import annotations

from dataclasses import dataclass

from tallystar.functions.dates import DATE_FORMAT


@dataclass(frozen=True)
class StarLayout:
    """Which columns of the wide source go to which table.

    The first column of a dimension is its natural key. The defaults are fixed
    values: the column names of the sales data. Sources with other columns pass
    their own lists; the reports need the columns they name.
    """

    customer: tuple[str, ...] = (
        "CUSTOMER_ID",
        "Customer Name",
        "CUSTOMER_LOGIN_ID",
        "CUSTOMER_STREET_ADDRESS",
        "CUSTOMER_CITY",
        "CUSTOMER_STATE",
        "CUSTOMER_ZIP",
        "CUSTOMER_PHONE_NO",
    )
    product: tuple[str, ...] = (
        "PRODUCT_ID",
        "CATEGORY_ID",
        "PRODUCT Name",
        "PRODUCT Brand",
        "Product Model No",
    )
    stock: str = "PRODUCT_STOCK"
    seller: tuple[str, ...] = (
        "SELLER_ID",
        "SELLER_NAME",
        "SELLER_RATING",
        "SELLER_STREET_ADDRESS",
        "SELLER_CITY",
        "SELLER_STATE",
        "SELLER_ZIP",
        "SELLER_PHONE_NO",
    )
    date: str = "Date"
    date_format: str = DATE_FORMAT
    transaction: tuple[str, ...] = (
        "TRANSACTION_ID",
        "TRANSACTION_DATE",
        "TRANSACTION_AMOUNT",
        "TRANSACTION_TYPE",
        "DISPATCH_DATE",
        "EXPECTED_DATE",
        "DELIVERY_DATE",
    )
    fact: tuple[str, ...] = (
        "TRANSACTION_ID",
        "PRODUCT_ID",
        "CUSTOMER_ID",
        "SELLER_ID",
        "PRODUCT_COST_PRICE",
        "PRODUCT_SELLING_PRICE",
    )
