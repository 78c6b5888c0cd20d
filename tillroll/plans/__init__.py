from .warehouse import Star, open_star, build_star

__all__ = ["Star", "open_star", "build_star"]
