"""The Java and interface parsers on small sources."""

from factloom.sources.aidl import parse_interface, statements
from factloom.sources.java import JavaFile, arguments, bare_type, blank_comments, unescape

SOURCE = '''
package com.example; // import not.This;
import android.os.ServiceManager;
import static com.keys.Names.DEMO;
import com.other.*;
/* class Ghost { } */
public class Example<T extends Base> {
    static final String BASE = "demo // not a comment";
    private static final String SERVICE = BASE;
    private Worker mWorker = make();
    class Inner { class Deep { } }
    private Helper make() { return null; }
    void start() {
        ServiceManager.addService(SERVICE, this);
        publishBinderService("a,b", mWorker, true);
        LocalServices.addService(Api.class, new Inner());
        LocalServices.addService(com.x.Api.class, make());
        ServiceManager.addService(only);
    }
}
'''


def test_comments_become_spaces_and_strings_stay():
    text = 'a /* x\ny */ "/* s */" // z\nb'
    out = blank_comments(text)
    assert len(out) == len(text) and out.count("\n") == 2 and '"/* s */"' in out and "x" not in out and "z" not in out


def test_context_and_classes():
    f = JavaFile(SOURCE)
    assert (f.package, f.wildcards) == ("com.example", ["com.other"])
    assert f.imports == {"ServiceManager": "android.os.ServiceManager", "DEMO": "com.keys.Names.DEMO"}
    assert [q for q, _, _ in f.classes] == ["com.example.Example", "com.example.Example.Inner", "com.example.Example.Inner.Deep"]
    assert f.class_at(f.text.index("class Deep {") + 12) == "com.example.Example.Inner.Deep"


def test_unclosed_class_is_left_out():
    assert JavaFile("class A { class B { }").classes == [("B", 18, 20)]


def test_registrations():
    calls = list(JavaFile(SOURCE).registrations())
    assert [(c["api"], c["kind"], c["guess"]) for c in calls] == [
        ("ServiceManager.addService", "binder", "com.example.Example"),
        ("publishBinderService", "binder", "com.example.Worker"),
        ("LocalServices.addService", "local", "com.example.Example.Inner"),
        ("LocalServices.addService", "local", "com.example.Helper"),
    ]
    assert calls[0]["names"] == ["SERVICE", "com.example.Example.SERVICE"] and calls[1]["value"] == "a,b"
    assert calls[2]["value"] == "com.example.Api" and calls[3]["value"] == "com.x.Api"
    assert calls[0]["line"] == SOURCE[: SOURCE.index("ServiceManager.addService(SERVICE")].count("\n") + 1


def test_constants_know_their_class():
    found = {c["qualified"]: c["value"] for c in JavaFile(SOURCE).constants()}
    assert found == {"com.example.Example.BASE": "demo // not a comment", "com.example.Example.SERVICE": None}


def test_arguments():
    assert arguments('"activity", createService(foo, bar), true') == ['"activity"', "createService(foo, bar)", "true"]
    assert arguments("new Map<A, B>(), x[1, 2], '\\'', \"a\\\",b\"") == ["new Map<A, B>()", "x[1, 2]", "'\\''", '"a\\",b"']
    assert arguments("") == [] and arguments("a,") == ["a"]


def test_types_and_literals():
    assert bare_type("Map<String, List<X>>[]") == "Map"
    assert unescape(r"a\tbA\"\101") == 'a\tbA"A'


def test_interface():
    package, name, imports, methods = parse_interface("""package android.example; import android.os.Bundle; // c
      oneway interface ITest { const int X = 1; int ping(int value); /* no(); */
        @Nullable(x = 1) void send(in Bundle
          data) throws E; List<String> all(in Map<String, int> m); unfinished()""" + " }")
    assert (package, name, imports) == ("android.example", "ITest", ["android.os.Bundle"])
    assert [(m["name"], m["signature"], m["return_type"]) for m in methods] == [("ping", "(int value)", "int"), ("send", "(in Bundle data)", "void"), ("all", "(in Map<String, int> m)", "List<String>")]


def test_statements_mind_brackets():
    assert statements("a(x; y); b<c;d>; e") == ["a(x; y)", "b<c;d>"]
