"""Column builders: every function takes and returns ``Column`` and runs in the JVM,
except ``sitemap.gunzip`` (Arrow batches), which has no built-in counterpart."""
