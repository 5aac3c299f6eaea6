from . import encodings, numeric  # noqa: F401
