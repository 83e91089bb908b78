from shelfline.streaming import activity, pulse

__all__ = ["activity", "pulse"]
