"""The feature job over a growing input folder."""
