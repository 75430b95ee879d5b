from starloom.plans.star import SOURCE_COLUMNS, build_star, land_sources, load_star, star_sizes, take_cut, within_cut

__all__ = ["SOURCE_COLUMNS", "build_star", "land_sources", "load_star", "star_sizes", "take_cut", "within_cut"]
