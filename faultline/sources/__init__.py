from .tables import read_table, tele, tele_ev, TELE_FEATURES  # noqa: F401
