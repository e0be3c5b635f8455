from vigiframe.functions import dates, scalars  # noqa: F401
