"""aulario: cleaning, reshaping and measuring school-programme data with Spark.

Every public function takes and returns Spark objects (``DataFrame`` or ``Column``) and
builds one lazy plan; nothing here collects data, and sizes are only checked where a
broadcast depends on them.
"""

__version__ = "0.1.0"
