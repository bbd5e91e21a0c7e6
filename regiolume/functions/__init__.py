from regiolume.functions import dates, numbers, recode, text

__all__ = ["dates", "numbers", "recode", "text"]
