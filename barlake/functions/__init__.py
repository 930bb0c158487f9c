from barlake.functions.casts import text_to_double, text_to_int, text_to_timestamp

__all__ = ["text_to_double", "text_to_int", "text_to_timestamp"]
