from colfit.sources.csv import load_csv

__all__ = ["load_csv"]
