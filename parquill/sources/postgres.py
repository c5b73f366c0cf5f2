"""PostgreSQL over JDBC: connection options, type discovery and pushed-down queries.

The server runs the user's query; types without a JDBC form are fetched as text output.
"""

from __future__ import annotations

import getpass
import os
import re
import sys
from collections.abc import Mapping
from dataclasses import dataclass, field
from urllib.parse import parse_qsl, unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession

from parquill.errors import ConnectionProblem, SettingsError
from parquill.types import ArrayOf, Composite, Domain, Enumeration, PgType, RangeOf, Simple

#: Types that Spark's JDBC reader maps by itself.
JDBC_TYPES = {"bool", "int2", "int4", "int8", "oid", "float4", "float8", "text", "varchar", "bpchar", "name", "bytea", "date", "timestamp", "timestamptz"}
SSL_MODES = ("disable", "prefer", "require")
APPLICATION = "parquill"


@dataclass(frozen=True)
class Connection:
    host: str
    dbname: str
    port: int = 5432
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    sslmode: str = "prefer"
    ssl_root_cert: str | None = None
    ssl_client_cert: str | None = None
    ssl_client_key: str | None = field(default=None, repr=False)

    def options(self) -> dict[str, str]:
        """Only `prefer` takes any certificate: the driver's own `require` does not look at it, so it is asked to verify."""
        mode = "verify-full" if self.sslmode == "require" else self.sslmode
        own_roots = "org.postgresql.ssl.DefaultJavaSSLFactory" if mode == "verify-full" and not self.ssl_root_cert else None
        found = {
            "url": f"jdbc:postgresql://{self.host}:{self.port}/{self.dbname}", "driver": "org.postgresql.Driver", "user": self.user, "password": self.password,
            "sslmode": mode, "sslfactory": own_roots, "sslrootcert": self.ssl_root_cert, "sslcert": self.ssl_client_cert, "sslkey": self.ssl_client_key, "ApplicationName": APPLICATION,
        }
        return {k: v for k, v in found.items() if v is not None}


def from_url(url: str, env: Mapping[str, str] | None = None) -> Connection:
    env = os.environ if env is None else env
    parts = urlsplit(url)
    if parts.scheme not in ("postgres", "postgresql") or not parts.hostname:
        raise ConnectionProblem("a connection string looks like postgresql://user:password@host:port/database; special characters in it are percent-encoded")
    extra = dict(parse_qsl(parts.query))
    dbname = unquote(parts.path.lstrip("/")) or (unquote(parts.username) if parts.username else None)
    if not dbname:
        raise ConnectionProblem("the connection string names neither a database nor a user")
    return Connection(
        parts.hostname, dbname, parts.port or 5432, unquote(parts.username) if parts.username else env.get("PGUSER") or dbname,
        unquote(parts.password) if parts.password else env.get("PGPASSWORD"), extra.get("sslmode", "prefer"), extra.get("sslrootcert"),
    )


def connection(
    *, url: str | None = None, host: str | None = None, dbname: str | None = None, port: int | None = None, user: str | None = None, password: str | None = None,
    sslmode: str | None = None, ssl_root_cert: str | None = None, ssl_client_cert: str | None = None, ssl_client_key: str | None = None, env: Mapping[str, str] | None = None, prompt=None,
) -> Connection:
    """From a connection string, else POSTGRES_URL, else DATABASE_URL, else the parts.

    User: given, PGUSER, the database's name. Password: given, in the string, PGPASSWORD, asked for
    on a terminal.
    """
    env = os.environ if env is None else env
    own = any(x is not None for x in (host, dbname, port, user, password, sslmode))
    if url and own:
        raise SettingsError("a connection string cannot be combined with host, user, dbname, port, password or sslmode")
    if sslmode is not None and sslmode not in SSL_MODES:
        raise SettingsError(f"sslmode {sslmode!r} is none of {', '.join(SSL_MODES)}")
    if (ssl_client_cert is None) != (ssl_client_key is None):
        raise SettingsError("a client certificate and its key go together")
    found = url or env.get("POSTGRES_URL") or env.get("DATABASE_URL")
    if found:
        if own:
            print("note: the connection string of the environment is used, not the host given", file=sys.stderr)
        made = from_url(found, env)
        return Connection(made.host, made.dbname, made.port, made.user, password or made.password, made.sslmode, ssl_root_cert or made.ssl_root_cert, ssl_client_cert, ssl_client_key)
    host = host or env.get("PGHOST")
    dbname = dbname or env.get("PGDATABASE")
    if not host or not dbname:
        raise SettingsError("host and dbname are needed, or a connection string")
    password = password or env.get("PGPASSWORD")
    if password is None and (prompt or sys.stdin.isatty()):
        password = (prompt or getpass.getpass)("Password: ")
    mode = sslmode or ("require" if ssl_root_cert else "prefer")
    return Connection(host, dbname, port or int(env.get("PGPORT", 5432)), user or env.get("PGUSER") or dbname, password, mode, ssl_root_cert, ssl_client_cert, ssl_client_key)


def quoted_table(name: str) -> str:
    """schema.table with both parts quoted; parts that are quoted already stay."""
    parts = re.findall(r'"(?:[^"]|"")+"|[^."]+', name)
    if not parts or ".".join(parts) != name:
        raise SettingsError(f"{name!r} is not a table name")
    return ".".join(p if p.startswith('"') else '"' + p.replace('"', '""') + '"' for p in parts)


def explained(error: Exception, at: Connection) -> ConnectionProblem:
    """A hint at what to do about a failed connection."""
    text = str(error)
    if re.search("SSL|certificate|PKIX", text):
        hint = "the server's TLS setup was refused: try sslmode=disable or =require, or give its root certificate"
    elif re.search("password|authentication", text):
        hint = "check user and password"
    elif re.search("refused|UnknownHost|timed out", text):
        hint = f"is a server listening at {at.host}:{at.port}?"
    elif re.search("ClassNotFound|No suitable driver|org.postgresql.Driver", text):
        hint = "the PostgreSQL JDBC driver is not on the class path (spark.jars)"
    else:
        hint = text.splitlines()[0][:300] if text else "unknown reason"
    return ConnectionProblem(f"cannot query {at.dbname} at {at.host}: {hint}")


def _ident(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def discovery_query(query: str, columns: list[str]) -> str:
    """One row of type names, also for an empty result."""
    picks = ", ".join(f"pg_typeof(q.{_ident(c)})::oid::bigint AS {_ident(c)}" for c in columns)
    return f"SELECT {picks} FROM (SELECT 1) o LEFT JOIN ({query}) q ON true LIMIT 1"


#: All types of the server: oid, name, kind, element or base, range subtype, labels, fields.
CATALOGUE = """
SELECT t.oid::bigint AS oid, t.typname::text AS name, t.typtype::text AS kind, t.typcategory::text AS category, t.typelem::bigint AS element, t.typbasetype::bigint AS base,
  (SELECT r.rngsubtype::bigint FROM pg_range r WHERE r.rngtypid = t.oid) AS subtype,
  (SELECT string_agg(e.enumlabel, chr(1) ORDER BY e.enumsortorder) FROM pg_enum e WHERE e.enumtypid = t.oid) AS labels,
  (SELECT string_agg(a.attname || chr(2) || a.atttypid::text, chr(1) ORDER BY a.attnum) FROM pg_attribute a WHERE a.attrelid = t.typrelid AND a.attnum > 0 AND NOT a.attisdropped) AS fields
FROM pg_type t"""


def type_tree(oid: int, rows: Mapping[int, Mapping]) -> PgType:
    """The type of an oid from catalogue rows."""
    r = rows[oid]
    if r["category"] == "A" and r["element"]:
        return ArrayOf(type_tree(r["element"], rows))
    if r["kind"] == "e":
        return Enumeration(tuple(r["labels"].split("\x01")), r["name"])
    if r["kind"] == "d":
        return Domain(type_tree(r["base"], rows), r["name"])
    if r["kind"] == "r":
        return RangeOf(type_tree(r["subtype"], rows))
    if r["kind"] == "c":
        fields = [f.split("\x02") for f in (r["fields"] or "").split("\x01") if f]
        return Composite(tuple((n, type_tree(int(o), rows)) for n, o in fields), r["name"])
    return Simple(r["name"])


def pushed_query(query: str, types: Mapping[str, PgType]) -> str:
    """The user's query with columns as text where JDBC has no fitting type."""
    plain = lambda t: isinstance(t, Simple) and t.name in JDBC_TYPES
    # the text of money follows the server's locale, its number does not
    form = lambda t: "numeric" if isinstance(t, Simple) and t.name == "money" else "text"
    picks = [f"q.{_ident(c)}" if plain(t) else f"q.{_ident(c)}::{form(t)} AS {_ident(c)}" for c, t in types.items()]
    return f"SELECT {', '.join(picks)} FROM ({query}) q"


def read_query(spark: SparkSession, at: Connection, query: str, *, fetch_size: int = 10_000, partition: Mapping[str, str] | None = None) -> tuple[DataFrame, dict[str, PgType]]:
    """A server-side query and the source types of its columns.

    partition: partitionColumn, lowerBound, upperBound and numPartitions, for reads in parallel.
    """
    query = query.strip().rstrip(";")
    base = spark.read.format("jdbc").options(**at.options()).option("fetchsize", str(fetch_size))
    try:
        columns = base.option("query", f"SELECT * FROM ({query}) q LIMIT 0").load().columns
        oids = base.option("query", discovery_query(query, columns)).load().first()
        rows = {r["oid"]: r.asDict() for r in base.option("query", CATALOGUE).load().collect()}
        types = {c: type_tree(oids[c], rows) for c in columns}
        pushed = pushed_query(query, types)
        reader = base.options(**partition).option("dbtable", f"({pushed}) p") if partition else base.option("query", pushed)
        return reader.load(), types
    except Exception as e:
        raise explained(e, at) from e


def read_table(spark: SparkSession, at: Connection, table: str, **more) -> tuple[DataFrame, dict[str, PgType]]:
    return read_query(spark, at, f"SELECT * FROM {quoted_table(table)}", **more)
