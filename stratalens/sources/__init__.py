"""Discovery of exports, header rules, loaders, and the lake."""
