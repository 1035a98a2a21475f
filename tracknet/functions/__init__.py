"""Column functions: built-in expressions only, so they stay inside codegen."""

from tracknet.functions.names import (  # noqa: F401
    catalog_from_path,
    rel_type_name,
    schema_from_path,
    user_identifier,
)
