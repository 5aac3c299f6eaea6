from .portfolio import portfolio_raw  # noqa: F401
