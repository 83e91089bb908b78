from shelfline.functions import clean, dates

__all__ = ["clean", "dates"]
