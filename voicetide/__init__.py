"""voicetide: customer-feedback escalation analytics as Spark DataFrame plans.

Landed posts from several platforms are normalised to one schema, filtered,
deduplicated, classified by data-driven regex taxonomies and rolled up into
brand-versus-brand tables.  Every public function takes DataFrames and plain
configuration objects and returns a lazy DataFrame.
"""

__version__ = "0.1.0"
