"""A warehouse connector over a folder: columns go by position, as some real ones place them."""

import json
import os
import uuid

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, WriterCommitMessage


class FakeWarehouse(DataSource):
    @classmethod
    def name(cls):
        return "fakehouse"

    def _folder(self):
        return f"{self.options['base']}/{self.options['dbtable']}"

    def schema(self):
        if not os.path.exists(f"{self._folder()}/schema"):
            raise ValueError(f"Object {self.options['dbtable']} does not exist")
        with open(f"{self._folder()}/schema") as file:
            return file.read()

    def reader(self, schema):
        return Reader(self._folder(), schema)

    def writer(self, schema, overwrite):
        return Writer(self._folder(), schema, overwrite)


class Reader(DataSourceReader):
    def __init__(self, folder, schema):
        self.folder, self.schema = folder, schema

    def read(self, partition):
        import datetime as dt

        kinds = [f.dataType.simpleString() for f in self.schema]
        back = {"timestamp": dt.datetime.fromisoformat, "date": dt.date.fromisoformat}
        for name in sorted(os.listdir(self.folder)):
            if name.endswith(".json"):
                with open(f"{self.folder}/{name}") as file:
                    for row in json.load(file):
                        yield tuple(
                            v if v is None or k not in back else back[k](v) for v, k in zip(row, kinds)
                        )


class Writer(DataSourceWriter):
    def __init__(self, folder, schema, overwrite):
        self.folder, self.overwrite = folder, overwrite
        self.ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)

    def write(self, rows):
        os.makedirs(self.folder, exist_ok=True)
        name = f"{uuid.uuid4().hex}.part"
        with open(f"{self.folder}/{name}", "w") as file:
            json.dump([[v if not hasattr(v, "isoformat") else v.isoformat() for v in r] for r in rows], file)
        return Message(name)

    def commit(self, messages):
        os.makedirs(self.folder, exist_ok=True)
        if self.overwrite:
            for name in os.listdir(self.folder):
                if name.endswith(".json"):
                    os.rename(f"{self.folder}/{name}", f"{self.folder}/{name}.old")
        if self.overwrite or not os.path.exists(f"{self.folder}/schema"):
            with open(f"{self.folder}/schema", "w") as file:
                file.write(self.ddl)
        for m in messages:
            os.rename(f"{self.folder}/{m.name}", f"{self.folder}/{m.name}.json")


class Message(WriterCommitMessage):
    def __init__(self, name):
        self.name = name
