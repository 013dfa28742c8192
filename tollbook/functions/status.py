"""Payment status, transaction type and post status columns, and the gateway's messages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tollbook.functions.values import is_empty_text

# Payment status labels.
STATUS_LABELS = {
    "Paid": "موفق",
    "Active": "موفق",
    "Cancelled": "منصرف شده",
    "Failed": "ناموفق",
    "Processing": "معلق",
}

# Feed type labels.
SUBSCRIPTION_LABEL = "عضویت"
PRODUCT_LABEL = "محصول معمولی یا فرم ارسال پست"

# Gateway result codes; {gateway} is the gateway's display name.
CODE_MESSAGES = {
    -1: "اطلاعات ارسال شده ناقص است .",
    -2: "آی پی یا مرچنت {gateway} اشتباه است .",
    -3: "با توجه به محدودیت های شاپرک امکان پرداخت با رقم درخواست شده میسر نمیباشد .",
    -4: "سطح تایید پذیرنده پایین تر از سطح نقره ای میباشد .",
    -11: "درخواست مورد نظر یافت نشد .",
    -21: "هیچ نوع عملیات مالی برای این تراکنش یافت نشد .",
    -22: "تراکنش نا موفق میباشد .",
    -33: "رقم تراکنش با رقم وارد شده مطابقت ندارد .",
    -40: "اجازه دسترسی به متد مورد نظر وجود ندارد .",
    -54: "درخواست مورد نظر آرشیو شده است .",
    100: "اتصال با {gateway} به خوبی برقرار شد و همه چیز صحیح است .",
    101: "تراکنش با موفقیت به پایان رسیده بود و تاییدیه آن نیز انجام شده بود .",
}
UNKNOWN_CODE_MESSAGE = " "

# The code of a verified payment, and the transaction types.
SUCCESS_CODE = 100
PRODUCT_TYPE, SUBSCRIPTION_TYPE = 1, 2

# Post statuses a feed may ask for.
POST_STATUSES = ("publish", "draft", "pending", "private")
REQUEST_DEFAULT_POST_STATUS = "pending"


def _lookup(col: Column, table: dict, default: Column) -> Column:
    for key, value in table.items():
        default = F.when(col == key, F.lit(value)).otherwise(default)
    return default


def status_label(status: Column) -> Column:
    return _lookup(status, STATUS_LABELS, F.lit(""))


def feed_type_label(feed_type: Column) -> Column:
    return F.when(feed_type == "subscription", F.lit(SUBSCRIPTION_LABEL)).otherwise(F.lit(PRODUCT_LABEL))


def code_message(code: Column, gateway_name: str) -> Column:
    """The message of a result code; a blank for a code without one."""
    table = {c: m.replace("{gateway}", gateway_name) for c, m in CODE_MESSAGES.items()}
    return _lookup(code, table, F.lit(UNKNOWN_CODE_MESSAGE))


def transaction_type(feed_type: Column) -> Column:
    return F.when(feed_type == "subscription", F.lit(SUBSCRIPTION_TYPE)).otherwise(F.lit(PRODUCT_TYPE))


def paid_status(txn_type: Column) -> Column:
    return F.when(txn_type == SUBSCRIPTION_TYPE, F.lit("Active")).otherwise(F.lit("Paid"))


def is_paid_status(status: Column) -> Column:
    return F.coalesce(status.isin("Paid", "Active"), F.lit(False))


def post_status_after_payment(action: Column, form_status: Column) -> Column:
    """The post status a feed asks for once paid, otherwise the form's own."""
    return F.when(action.isin(*POST_STATUSES), action).otherwise(form_status)


def post_status_at_request(action: Column, form_status: Column) -> Column:
    """The post status while payment is open; no action or `dont` keeps the form's own."""
    asked = F.when(action.isin(*POST_STATUSES), action).otherwise(F.lit(REQUEST_DEFAULT_POST_STATUS))
    return F.when(is_empty_text(action) | (action == "dont"), form_status).otherwise(asked)


def free_transaction_id(lead_id: Column) -> Column:
    """A ten-digit number drawn from the lead id, so that a retried task draws the same one."""
    digest = F.conv(F.substring(F.md5(lead_id.cast("string")), 1, 15), 16, 10).cast("bigint")
    return (digest % 9000000000 + 1000000000).cast("string")
