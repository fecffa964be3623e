"""The commerce event contract, version 1, as data: fields, rules and parent-child tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.rules import (
    array_size_not, blank, child_not_of_parent, not_one_of, outside, pattern, when,
)
from millrace.operators.contract import Contract, Field

# The contract's versions, field types, patterns, ranges and enumerations.
CONTRACT_VERSION = "ecommerce-event-v1"
INTEGER = {"day_diff": "int", "helpful_yes": "int", "total_vote": "int", "quantity": "int", "unixReviewTime": "long"}
NUMBER = ["overall", "unitPrice", "totalAmount"]
SUBCATEGORIES = {
    "Điện tử": ["Điện thoại", "Laptop", "Tai nghe", "Đồng hồ thông minh"],
    "Thời trang": ["Áo thun", "Quần Jeans", "Giày Sneaker", "Áo khoác"],
    "Gia dụng": ["Máy xay sinh tố", "Lò vi sóng", "Nồi chiên không dầu", "Máy hút bụi"],
    "Mỹ phẩm": ["Son môi", "Serum", "Nước hoa", "Sữa rửa mặt"],
}
CITIES = {
    "Miền Bắc": ["Hà Nội", "Hải Phòng", "Quảng Ninh"],
    "Miền Trung": ["Đà Nẵng", "Huế", "Nha Trang"],
    "Miền Nam": ["Hồ Chí Minh", "Cần Thơ", "Đồng Nai"],
}
USUAL_BRANDS = {
    "Điện tử": ["Apple", "Samsung", "Sony", "LG"],
    "Thời trang": ["Nike", "Adidas"],
    "Gia dụng": ["Philips", "Lock&Lock", "Dyson", "LG"],
    "Mỹ phẩm": ["L'Oreal"],
}
STORE_TYPES = ["Cửa hàng Vật lý", "Web Online", "Mobile App"]
PAYMENT_METHODS = ["Tiền mặt (COD)", "Thẻ Tín Dụng", "Momo", "ZaloPay", "VNPay"]
PAID, PENDING, FAILED = "Thành công", "Đang xử lý", "Thất bại"
SHIPPING_METHODS = ["Hỏa tốc", "Tiêu chuẩn", "Tiết kiệm"]
CARRIERS = ["Giao Hàng Nhanh", "Viettel Post", "Shopee Express", "Ninja Van", "J&T Express"]
DELIVERED, MOVING, RETURNED = "Đã giao", "Đang vận chuyển", "Hoàn hàng"


def _all(table: dict[str, list[str]]) -> list[str]:
    return list(dict.fromkeys(x for values in table.values() for x in values))


def _unsettled(get) -> Column:
    failed = (get("paymentStatus") == FAILED) & get("shippingStatus").isin(DELIVERED, MOVING)
    return failed | ((get("paymentStatus") == PENDING) & (get("shippingStatus") == DELIVERED))


def _other_day(get) -> Column:
    """The written day is not the day of the epoch seconds in the session zone; unreadable text is another day."""
    written = F.try_to_timestamp(get("reviewTime"), F.lit("MM dd, yyyy")).cast("date")
    return F.coalesce(written != F.timestamp_seconds(get("unixReviewTime")).cast("date"), get("reviewTime").isNotNull())


# The field rules' codes, patterns and ranges.
FIELD_RULES = [
    pattern("E101_REVIEWER_ID_PATTERN", "reviewerID", r"^[A-Z0-9]{14}$"),
    pattern("E102_ASIN_PATTERN", "asin", r"^B0[A-Z0-9]{8}$"),
    blank("E103_REVIEW_TEXT_EMPTY", "reviewText"),
    not_one_of("E104_OVERALL_RANGE", "overall", [1.0, 2.0, 3.0, 4.0, 5.0]),
    blank("E105_SUMMARY_EMPTY", "summary"),
    outside("E106_REVIEW_TIME_RANGE", "unixReviewTime", 1672500000, 1735700000),
    outside("E107_DAY_DIFF_RANGE", "day_diff", 4, 1064),
    outside("E108_HELPFUL_YES_RANGE", "helpful_yes", 0, 500),
    outside("E109_TOTAL_VOTE_RANGE", "total_vote", 0, 500),
    blank("E110_PRODUCT_NAME_EMPTY", "productName"),
    not_one_of("E111_CATEGORY_ENUM", "category", list(SUBCATEGORIES)),
    not_one_of("E112_SUBCATEGORY_ENUM", "sub_category", _all(SUBCATEGORIES)),
    not_one_of("E113_BRAND_ENUM", "brand", _all(USUAL_BRANDS)),
    outside("E114_UNIT_PRICE_RANGE", "unitPrice", 50_000, 5_000_000),
    pattern("E115_ORDER_ID_PATTERN", "orderID", r"^ORD-[A-Z0-9]{10}$"),
    outside("E116_QUANTITY_RANGE", "quantity", 1, 4),
    outside("E117_TOTAL_AMOUNT_RANGE", "totalAmount", 50_000, 20_000_000),
    pattern("E118_STORE_ID_PATTERN", "storeID", r"^STR-.+-(?:[1-9]|10)$"),
    blank("E119_STORE_NAME_EMPTY", "storeName"),
    not_one_of("E120_CITY_ENUM", "city", _all(CITIES)),
    not_one_of("E121_REGION_ENUM", "region", list(CITIES)),
    not_one_of("E122_STORE_TYPE_ENUM", "storeType", STORE_TYPES),
    pattern("E123_PAYMENT_ID_PATTERN", "paymentID", r"^PAY-[A-Z0-9]{10}$"),
    not_one_of("E124_PAYMENT_METHOD_ENUM", "paymentMethod", PAYMENT_METHODS),
    not_one_of("E125_PAYMENT_STATUS_ENUM", "paymentStatus", [PAID, PENDING, FAILED]),
    pattern("E126_SHIPPING_ID_PATTERN", "shippingID", r"^SHP-[A-Z0-9]{10}$"),
    not_one_of("E127_SHIPPING_METHOD_ENUM", "shippingMethod", SHIPPING_METHODS),
    not_one_of("E128_CARRIER_ENUM", "carrierName", CARRIERS),
    not_one_of("E129_SHIPPING_STATUS_ENUM", "shippingStatus", [DELIVERED, MOVING, RETURNED]),
    array_size_not("E130_HELPFUL_SHAPE", "helpful", 2),
]
# The cross-field rules' codes and conditions.
CROSS_RULES = [
    when("E201_TOTAL_AMOUNT_MISMATCH", lambda get: F.abs(get("totalAmount") - get("unitPrice") * get("quantity")) > 0.001),
    when(
        "E202_HELPFUL_MISMATCH",
        lambda get: (F.get(get("helpful"), F.lit(0)) != get("helpful_yes")) | (F.get(get("helpful"), F.lit(1)) != get("total_vote")),
    ),
    when("E203_HELPFUL_EXCEEDS_TOTAL", lambda get: get("helpful_yes") > get("total_vote")),
    child_not_of_parent("E204_CATEGORY_SUBCATEGORY_MISMATCH", "category", "sub_category", SUBCATEGORIES),
    child_not_of_parent("E205_REGION_CITY_MISMATCH", "region", "city", CITIES),
    when("E206_REVIEW_TIME_MISMATCH", _other_day),
]
# The warnings' codes and conditions.
WARNING_RULES = [
    child_not_of_parent("W101_UNUSUAL_BRAND_CATEGORY", "category", "brand", USUAL_BRANDS),
    when("W102_PAYMENT_SHIPPING_INCONSISTENT", _unsettled),
]

#: Extra rules of the written profile, for callers that want them: whole-number money and votes in range.
STRICTER_RULES = [
    pattern("P101_REVIEW_TIME_PATTERN", "reviewTime", r"^(0[1-9]|1[0-2]) (0[1-9]|[12]\d|3[01]), \d{4}$"),
    when("P102_UNIT_PRICE_WHOLE", lambda get: get("unitPrice") != F.floor(get("unitPrice"))),
    when("P103_TOTAL_AMOUNT_WHOLE", lambda get: get("totalAmount") != F.floor(get("totalAmount"))),
    when("P104_HELPFUL_RANGE", lambda get: F.exists(get("helpful"), lambda v: ~v.between(0, 500))),
]

# The order of the fields.
_ORDER = [
    "reviewerID", "asin", "reviewerName", "helpful", "reviewText", "overall", "summary", "unixReviewTime", "reviewTime",
    "day_diff", "helpful_yes", "total_vote", "productName", "category", "sub_category", "brand", "unitPrice", "orderID",
    "quantity", "totalAmount", "storeID", "storeName", "city", "region", "storeType", "paymentID", "paymentMethod",
    "paymentStatus", "shippingID", "shippingMethod", "carrierName", "shippingStatus",
]


def _field(name: str) -> Field:
    if name == "helpful":
        return Field(name, "array<int>", kind="integers")
    if name in INTEGER:
        return Field(name, INTEGER[name], kind="integer")
    if name in NUMBER:
        return Field(name, "double", kind="number")
    return Field(name, "string", kind="string", nullable=name == "reviewerName")


COMMERCE = Contract(
    version=CONTRACT_VERSION,
    fields=tuple(map(_field, _ORDER)),
    field_rules=tuple(FIELD_RULES),
    cross_rules=tuple(CROSS_RULES),
    warning_rules=tuple(WARNING_RULES),
)
