"""Table layouts shared by the operators."""

SOURCES = "source_id long, source string"
URLS = "source_id long, ord long, url string"
RESPONSES = (
    "url string, code string, message string, content_type string, location string, "
    "body binary, error_class string, error_message string"
)
RESULTS = (
    "source_id long, ord long, uri string, code string, request_url string, "
    "response_error string, error_class string, error_message string"
)
