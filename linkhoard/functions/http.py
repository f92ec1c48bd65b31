"""Response columns: status classes, outcomes and the error taxonomy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import urls

# Transport error class -> error family.
ERROR_FAMILIES = {
    "Timeout::Error": "ServerError",
    "OpenSSL::SSL::SSLError": "ServerError",
    "Net::HTTPBadResponse": "ServerError",
    "Zlib::Error": "ServerError",
    "SystemCallError": "ClientError",
    "SocketError": "ClientError",
    "IOError": "ClientError",
}
# Subclasses a fetcher may record instead of the classes above.
ERROR_SUBCLASSES = {
    r"^Net::(Open|Read|Write)Timeout$": "ServerError",
    r"^Zlib::": "ServerError",
    r"^Errno::": "ClientError",
    r"^Socket::": "ClientError",
    r"^EOFError$": "ClientError",
}
# The error taxonomy; a recorded member is kept as it is.
TAXONOMY = (
    "Error",
    "ClientError",
    "ServerError",
    "HTTPError",
    "ResponseError",
    "MaxRedirectError",
    "InvalidRedirectError",
    "UnknownResponseCodeError",
    "InvalidURIError",
)

RESPONSE, FOLLOW = "response", "follow"


def _text(code: Column) -> Column:
    return F.coalesce(code.cast("string"), F.lit(""))


def is_success(code: Column) -> Column:
    return _text(code).rlike("2[0-9][0-9]")


def is_redirect(code: Column) -> Column:
    return _text(code).rlike("3[0-9][0-9]")


def is_error(code: Column) -> Column:
    return _text(code).rlike("[45][0-9][0-9]")


def code_type(code: Column) -> Column:
    """Status class; tests are unanchored and tried in the order success, redirect, error."""
    return (
        F.when(is_success(code), "success")
        .when(is_redirect(code), "redirect")
        .when(is_error(code), "error")
        .otherwise("unknown")
    )


def error_family(error_class: Column) -> Column:
    """Family of a recorded transport error; NULL stays NULL, unknown classes become ``Error``."""
    family = F.when(error_class.isin(*TAXONOMY), error_class)
    for name, value in ERROR_FAMILIES.items():
        family = family.when(error_class == name, value)
    for pattern, value in ERROR_SUBCLASSES.items():
        family = family.when(error_class.rlike(pattern), value)
    return F.when(error_class.isNotNull(), family.otherwise("Error"))


def outcome(
    code: Column,
    error_class: Column,
    *,
    follow_redirects: bool = True,
    raise_on_http_error: bool = False,
) -> Column:
    """What one exchange leads to: ``response``, ``follow``, or an error class."""
    kind = code_type(code)
    return (
        F.when(error_class.isNotNull(), error_family(error_class))
        .when(kind == "success", RESPONSE)
        .when(kind == "redirect", FOLLOW if follow_redirects else RESPONSE)
        .when(kind == "error", "ResponseError" if raise_on_http_error else RESPONSE)
        .otherwise("UnknownResponseCodeError")
    )


def redirect_target(current: Column, location: Column) -> Column:
    """Next URL of a redirect; NULL when the location is missing or malformed."""
    return F.when(urls.is_reference(location), urls.resolve(current, location))


def redirect_error(location: Column) -> Column:
    """Why a redirect cannot be followed, NULL when it can."""
    return F.when(location.isNull(), "InvalidRedirectError").when(
        ~urls.is_reference(location), "InvalidURIError"
    )
